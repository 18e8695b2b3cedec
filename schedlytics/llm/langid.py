"""Language identification of mixed text: scripts narrow the candidates, Viterbi over per-word scores labels spans.

Learned from texts with a known language: for each language, how often each hashed character n-gram of its words occurs, and
which scripts its letters have. A word's score for a language is the mean log-likelihood of its n-grams. A language whose
learned share of the word's script is nil is no candidate. Along the words of a text the best path pays a penalty for every
change of language; runs of one label are the spans.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schedlytics.llm.tables import blocks, small_batches, text_column
from schedlytics.llm.words import BASE, mix

# Hashed n-grams of a language; the model's size is this times languages, whatever the input.
BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
# What a change of language costs, in units of a word's score.
SWITCH = 4.0
# First code points of script blocks, and the script that each starts.
SCRIPTS = [
    (0x0000, "none"), (0x0041, "Latin"), (0x005B, "none"), (0x0061, "Latin"), (0x007B, "none"), (0x00AA, "Latin"), (0x00AB, "none"), (0x00B5, "Latin"),
    (0x00B6, "none"), (0x00BA, "Latin"), (0x00BB, "none"), (0x00C0, "Latin"), (0x00D7, "none"), (0x00D8, "Latin"), (0x00F7, "none"), (0x00F8, "Latin"),
    (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Syriac"),
    (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Other"), (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "none"), (0x2C00, "Other"), (0x2E00, "none"), (0x3005, "Han"), (0x3008, "none"),
    (0x3040, "Kana"), (0x3100, "Other"), (0x3130, "Hangul"), (0x3190, "none"), (0x31F0, "Kana"), (0x3200, "none"), (0x3400, "Han"), (0x4DC0, "none"), (0x4E00, "Han"),
    (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "none"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"), (0xFB50, "Arabic"), (0xFE00, "none"), (0xFE70, "Arabic"),
    (0xFF00, "none"), (0xFF21, "Latin"), (0xFF3B, "none"), (0xFF41, "Latin"), (0xFF5B, "none"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "none"),
    (0x10000, "Other"), (0x1F000, "none"), (0x20000, "Han"), (0x30000, "Han"), (0x323B0, "none"),
]
NAMES = sorted({name for _, name in SCRIPTS} - {"none"})


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """First code points of runs of one kind, and their kinds: 0 is neither letter nor mark, else the place of the script in
    NAMES from 1 on, plus LETTER for letters. A block says the script, the Unicode category says what is a letter; a letter of a
    block without script is of an other one."""
    category = np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], dtype=np.uint8)
    script = np.zeros(0x110000, dtype=np.uint8)
    for (low, name), (high, _) in zip(SCRIPTS, [*SCRIPTS[1:], (0x110000, "")], strict=True):
        script[low:high] = 0 if name == "none" else NAMES.index(name) + 1
    script[(script == 0) & (category == 2)] = NAMES.index("Other") + 1
    kind = np.where(category == 2, script + LETTER, np.where(category == 1, script, 0)).astype(np.uint8)
    borders = np.flatnonzero(np.diff(kind, prepend=255))
    return borders.astype(np.uint32), kind[borders]


# Kinds from here on are letters; those below are marks, which belong to the word they stand in.
LETTER = 64
BORDERS, KINDS = _kinds()


@dataclass
class LetterRuns:
    """Words of several texts: maximal runs of letters of one script and their marks, as code points folded to lower case."""

    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    script: np.ndarray
    text: np.ndarray
    places: np.ndarray


def letter_runs(texts: list[str]) -> LetterRuns:
    """Cut texts into letter runs; ``places`` are offsets of the runs in their own text, ``text`` is its number."""
    joined = "\n".join(texts)
    folded = joined.lower()
    if len(folded) != len(joined):
        folded = "".join(c if len(c.lower()) != 1 else c.lower() for c in joined)
    points = np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    plain = KINDS[np.searchsorted(BORDERS, np.arange(0x800, dtype=np.uint32), side="right") - 1]
    kind = plain[np.minimum(points, 0x7FF)]
    far = np.flatnonzero(points >= 0x800)
    kind[far] = KINDS[np.searchsorted(BORDERS, points[far], side="right") - 1]
    marks = np.flatnonzero((kind > 0) & (kind < LETTER))
    kind &= LETTER - 1
    change = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    edges = np.append(change, len(kind)) if len(kind) else change
    low, high = edges[:-1], edges[1:]
    keep = (high > low) & (kind[np.minimum(low, max(0, len(kind) - 1))] > 0) if len(kind) else np.zeros(len(low), dtype=bool)
    low, high = low[keep], high[keep]
    if len(marks):
        # A run of marks alone is no word.
        spelt = np.searchsorted(marks, high) - np.searchsorted(marks, low) < high - low
        low, high = low[spelt], high[spelt]
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    text = np.searchsorted(offsets, low, side="right") - 1
    return LetterRuns(points, low, high, kind[low] if len(low) else np.zeros(0, np.uint8), text, low - offsets[text])


def grams(runs: LetterRuns) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the runs (with a mark at both ends), and the run of each."""
    lengths = runs.ends - runs.starts + 2
    first = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=first[1:])
    run = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(first[-1], dtype=np.int64) - first[run]
    marked = np.full(first[-1], 1, dtype=np.uint64)
    inner = (place > 0) & (place < lengths[run] - 1)
    marked[inner] = runs.points[(runs.starts[run] + place - 1)[inner]]
    out, owner = [], []
    value = np.zeros(len(marked), dtype=np.uint64)
    left = lengths[run] - place
    for n in range(1, max(GRAMS) + 1):
        value[:len(marked) - n + 1] = value[:len(marked) - n + 1] * BASE + marked[n - 1:] + np.uint64(n)
        if n in GRAMS:
            at = np.flatnonzero(left >= n)
            out.append((mix(value[at]) % np.uint64(BUCKETS)).astype(np.int32))
            owner.append(run[at])
    return np.concatenate(out), np.concatenate(owner)


@dataclass
class LanguageModel:
    """Scores of shape (buckets, languages) and the languages possible for each script (0: unknown script)."""

    languages: list[str]
    scores: np.ndarray
    possible: np.ndarray


def train(docs: DataFrame) -> LanguageModel:
    """Learn from all rows of ``docs`` (text, lang) with both; the driver gets counts of a fixed number of buckets per language.

    ``lang`` is taken to have few values, as languages do: the model grows with their number, not with the rows.
    """
    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    small_batches(docs.sparkSession)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = text_column(batch, "text"), np.array(batch.column("lang").to_pylist(), dtype=object)
            for low, high in blocks(texts):
                runs = letter_runs(texts.slice(low, high - low).to_pylist())
                if not len(runs.starts):
                    continue
                bucket, owner = grams(runs)
                lang_of = langs[low:high][runs.text]
                for lang in set(langs[low:high]):
                    own = lang_of == lang
                    total = sums.setdefault(lang, np.zeros(BUCKETS + len(NAMES) + 1, dtype=np.int64))
                    total[:BUCKETS] += np.bincount(bucket[own[owner]], minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(runs.script[own], weights=(runs.ends - runs.starts)[own], minlength=len(NAMES) + 1).astype(np.int64)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int64)), pa.array(total[at])], ["lang", "cell", "n"])

    rows = known.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r.lang for r in rows})
    counts = np.zeros((BUCKETS + len(NAMES) + 1, len(languages)))
    for r in rows:
        counts[r.cell, languages.index(r.lang)] = r.n
    own, script = counts[:BUCKETS], counts[BUCKETS:]
    scores = np.log((own + 0.5) / (own.sum(axis=0) + 0.5 * BUCKETS)) if languages else own
    share = script / np.maximum(script.sum(axis=0), 1)
    possible = share >= 0.001
    possible[~possible.any(axis=1)] = True
    return LanguageModel(languages, scores.astype(np.float32), possible)


def word_scores(model: LanguageModel, runs: LetterRuns) -> np.ndarray:
    """Mean n-gram log-likelihood of each run for each language; impossible languages get a very low one."""
    bucket, owner = grams(runs)
    order = np.argsort(owner, kind="stable")
    bucket, owner = bucket[order], owner[order]
    sums = np.add.reduceat(model.scores[bucket], np.searchsorted(owner, np.arange(len(runs.starts))), axis=0)
    means = sums / np.bincount(owner, minlength=len(runs.starts))[:, None].astype(np.float32)
    return np.where(model.possible[runs.script], means, np.float32(-50))


def viterbi(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each run: all texts advance together, one run of each per step, longest texts first."""
    counts = np.bincount(text)
    used = np.flatnonzero(counts)
    starts = np.searchsorted(text, used)
    order = np.argsort(-counts[used], kind="stable")
    starts, lengths = starts[order], counts[used][order]
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    stay = np.ones(scores.shape, dtype=bool)
    jump = np.zeros(len(scores), dtype=np.int32)
    best = scores[starts].copy()
    for t in range(1, int(lengths[0])):
        n = int(alive[t])
        at = starts[:n] + t
        now = best[:n]
        top = now.argmax(axis=1)
        other = now[np.arange(n), top][:, None] - np.float32(switch)
        stay[at] = now >= other
        jump[at] = top
        best[:n] = np.maximum(now, other) + scores[at]
    label = np.zeros(len(scores), dtype=np.int32)
    state = best.argmax(axis=1).astype(np.int32)
    for t in range(int(lengths[0]) - 1, -1, -1):
        n = int(alive[t])
        at = starts[:n] + t
        label[at] = state[:n]
        state[:n] = np.where(stay[at, state[:n]], state[:n], jump[at])
    return label


def predict(docs: DataFrame, model: LanguageModel, switch: float = SWITCH, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, the columns ``keep``, lang_pred, score and spans (start and end in characters, lang, letters).

    lang_pred is the label with most letters (ties: first by name), score its share of the letters. A null text, one without
    letters (Unicode category L), or an empty model: ``und``, score 0, no spans. Repeated rows are rows of their own, an empty
    table gives none.
    """
    small_batches(docs.sparkSession)
    source = docs.select("doc_id", *keep, F.col("text").cast("string").alias("text"))
    names = model.languages
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string()), ("letters", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = text_column(batch, "text")
            lang, share, spans = [], [], []
            for low, high in blocks(texts, 1 << 20):
                runs = letter_runs(texts.slice(low, high - low).to_pylist())
                count = high - low
                letters = np.zeros((count, max(1, len(names))))
                cells: list[list] = [[] for _ in range(count)]
                if len(runs.starts) and names:
                    label = viterbi(word_scores(model, runs), runs.text, switch)
                    size = runs.ends - runs.starts
                    np.add.at(letters, (runs.text, label), size)
                    new = np.flatnonzero((np.diff(runs.text, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
                    last = np.append(new[1:], len(label)) - 1
                    total = np.add.reduceat(size, new)
                    finish = (runs.places + size)[last]
                    for t, a, b, k, n in zip(runs.text[new].tolist(), runs.places[new].tolist(), finish.tolist(), label[new].tolist(), total.tolist(), strict=True):
                        cells[t].append({"start": a, "end": b, "lang": names[k], "letters": n})
                whole = letters.sum(axis=1)
                top = letters.argmax(axis=1)
                lang += [names[k] if n else "und" for k, n in zip(top.tolist(), whole.tolist(), strict=True)]
                share += np.where(whole > 0, letters[np.arange(count), top] / np.maximum(whole, 1), 0.0).tolist()
                spans += cells
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in ("doc_id", *keep)], pa.array(lang, pa.string()), pa.array(share, pa.float64()), pa.array(spans, pa.list_(span))], ["doc_id", *keep, "lang_pred", "score", "spans"])

    kinds = dict(source.dtypes)
    return source.mapInArrow(run, "".join(f"`{k}` {kinds[k]}, " for k in ("doc_id", *keep)) + "lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string,letters:bigint>>")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2 (a null id is not)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
