"""Masked pseudo-likelihood: a bidirectional window network, trained in numpy on the whole corpus, scores documents.

The probability of a word has two levels: its class given both sides, and the word given its class. The most frequent words are
classes of their own, all others share hashed classes. The network hides a token and predicts its class from the two on
either side: tanh of the sum of one embedding per place, then a softmax. Every word of the corpus is counted by itself, however
many there are: the words with the highest counts travel to the texts as a table, the counts of all others are joined to the
texts that have them. A hidden token does not know itself, so its word has the share that it has in the class without that token. The
score of a text is the sum of log P(token | both sides) over all its tokens. Training is data parallel: a round starts every task from the same
weights, each task descends over its texts, and the weights are averaged by tokens seen. Nothing but weights of a fixed
size comes back, and they are summed in a tree so that many tasks do not meet on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schedlytics.llm.tables import blocks, small_batches, staged, text_column
from schedlytics.llm.words import words_of
from schedlytics.session import work_dir

# Classes: 0 is beyond the text, then the frequent words, then the hashed classes of all others.
TOP, HASHED = 95, 32
CLASSES = 1 + TOP + HASHED
SIDE = 2
PLACES = [k for k in range(-SIDE, SIDE + 1) if k]
HIDDEN = 16
# Words of the hashed classes that travel as a table, at most. It changes no result: all others are joined.
CARRIED = 1 << 18
# What a word counts for beyond its tokens.
SMOOTHING = 0.5
# Each round descends on every token once. Texts of about STEPS batches are dealt out together, so that a batch mixes texts.
ROUNDS, STEPS = 3, 16
RATE, BATCH = 0.15, 2048
# Words that a task counts before it reports them, and tokens scored at once.
WORKING_SET, STEP = 2_000_000, 1 << 15
# Weights that are summed in one place.
FAN_IN = 64


# Places that are worked on at once: their arrays stay in a core's cache.
ROWS = 1024
ONES = np.ones(CLASSES, dtype=np.float32)


class Room:
    """Working arrays for ``ROWS`` places, used again and again."""

    def __init__(self):
        self.hidden, self.beside = np.empty((ROWS, HIDDEN), dtype=np.float32), np.empty((ROWS, HIDDEN), dtype=np.float32)
        self.logits = np.empty((ROWS, CLASSES), dtype=np.float32)


@dataclass
class Network:
    """Embeddings per place, hidden bias, output matrix and bias."""

    into: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    prior: np.ndarray

    @staticmethod
    def fresh(seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        shape = (len(PLACES), CLASSES, HIDDEN)
        return Network(*[x.astype(np.float32) for x in (rng.normal(0, 0.1, shape), np.zeros(HIDDEN), rng.normal(0, 0.1, (HIDDEN, CLASSES)), np.zeros(CLASSES))])

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.into, self.bias, self.out, self.prior)])

    @staticmethod
    def of(flat: np.ndarray) -> Network:
        shapes = [(len(PLACES), CLASSES, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]
        parts = np.split(flat.astype(np.float32), np.cumsum([int(np.prod(s)) for s in shapes])[:-1])
        return Network(*[p.reshape(s).copy() for p, s in zip(parts, shapes, strict=True)])

    def weigh(self, line: np.ndarray, at: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For at most ``ROWS`` places of a line of tokens: hidden states, the weight of each class, their sum, and the tokens' logits.

        The weights are exponentials of logits, shifted by the largest of a place only where the sizes of the parameters
        do not rule an overflow out.
        """
        n = len(at)
        hidden, beside, logits = room.hidden[:n], room.beside[:n], room.logits[:n]
        hidden[:] = self.bias
        for table, k in zip(self.into, PLACES, strict=True):
            np.take(table, line[at + k], axis=0, out=beside, mode="clip")
            hidden += beside
        np.tanh(hidden, out=hidden)
        np.matmul(hidden, self.out, out=logits)
        logits += self.prior
        if (np.abs(self.out).sum(axis=0) + np.abs(self.prior)).max() > 60:
            logits -= logits.max(axis=1, keepdims=True)
        own = logits[np.arange(n), line[at]]
        np.exp(logits, out=logits)
        return hidden, logits, logits @ ONES, own

    def log_probability(self, line: np.ndarray, at: np.ndarray, room: Room) -> np.ndarray:
        """log P(token | both sides) of the tokens at the places ``at``."""
        logs = np.empty(len(at))
        for low in range(0, len(at), ROWS):
            _, _, total, own = self.weigh(line, at[low:low + ROWS], room)
            logs[low:low + ROWS] = own - np.log(total)
        return logs

    def descend(self, line: np.ndarray, at: np.ndarray, squares: list[np.ndarray], room: Room) -> None:
        """One adaptive gradient step on the mean loss of the places ``at``."""
        back, shares = np.empty((HIDDEN, len(PLACES), len(at))), np.empty(len(at), dtype=np.float32)
        out, prior = np.zeros_like(self.out), np.zeros_like(self.prior)
        for low in range(0, len(at), ROWS):
            part = at[low:low + ROWS]
            hidden, weights, total, _ = self.weigh(line, part, room)
            # Gradients of logits are weights by their sum, less one at the token: the division is done on the narrow side of each product.
            weights[np.arange(len(part)), line[part]] -= total
            share = np.divide(np.float32(1 / len(at)), total, out=shares[low:low + ROWS])
            prior += share @ weights
            slope = weights @ self.out.T
            out += (weights.T @ (hidden * share[:, None])).T
            slope *= (1 - hidden * hidden) * share[:, None]
            back[:, 0, low:low + ROWS] = slope.T
        # The embeddings of all places are one table, and each of its rows gets the sum over the tokens that used it.
        back[:, 1:] = back[:, :1]
        used = np.concatenate([line[at + k] + i * CLASSES for i, k in enumerate(PLACES)])
        into = np.stack([np.bincount(used, x.ravel(), len(PLACES) * CLASSES) for x in back], axis=1)
        grads = [into.reshape(self.into.shape).astype(np.float32), back[:, 0].sum(axis=1).astype(np.float32), out, prior]
        for own, grad, seen in zip((self.into, self.bias, self.out, self.prior), grads, squares, strict=True):
            seen += grad * grad
            own -= RATE * grad / (np.sqrt(seen) + 1e-6)


@dataclass
class Vocabulary:
    """Hashes of the ``TOP`` most frequent words, most frequent first (ties by hash), and log P(word | class) of all others.

    The commonest of the others are ``carried`` (ascending hashes) with their ``logs``, the ``rest`` is a table (word, log).
    """

    frequent: np.ndarray
    carried: np.ndarray
    logs: np.ndarray
    rest: DataFrame
    folder: str


def _find(sought: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the ascending ``known``, and whether they hold what is sought."""
    if not len(known):
        return np.zeros(len(sought), dtype=np.int64), np.zeros(len(sought), dtype=bool)
    at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
    return at, known[at] == sought


def vocabulary(docs: DataFrame, folder: str) -> Vocabulary:
    """Count the words of all texts. The driver gets ``TOP`` words, ``CARRIED`` more at most, and a row per class."""

    def count(batches):
        held, size = [], 0

        def flush():
            words, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

        for batch in batches:
            texts = text_column(batch, "text")
            for low, high in blocks(texts):
                hashes = words_of(texts.slice(low, high - low), lower=True).hashes()
                held.append(hashes)
                size += len(hashes)
                if size >= WORKING_SET:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counted = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = staged(counted, "words", folder)
    frequent = [r.word for r in rows.orderBy(F.desc("n"), "word").limit(TOP).collect()]
    others = rows.where(~F.col("word").isin(frequent)) if frequent else rows
    # The same bits as of the unsigned hash, since the number of classes is a power of two.
    own = F.col("word").bitwiseAND(HASHED - 1).cast("int")
    sizes = {r.own: r for r in others.groupBy(own.alias("own")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()}
    # Without the token itself: its word has n - 1 tokens, its class has one less.
    mass = [sizes[k].n - 1 + SMOOTHING * sizes[k].words if k in sizes else 1.0 for k in range(HASHED)]
    given = others.select("word", F.log((F.col("n") - 1 + SMOOTHING) / F.element_at(F.array(*map(F.lit, mass)), own + 1)).alias("log"), (4 * F.log2("n")).cast("int").alias("size"))
    given, least, held = staged(given, "given_class", folder), 256, 0
    for r in sorted(given.groupBy("size").count().collect(), key=lambda r: -r["size"]):
        held += r["count"]
        if held > CARRIED:
            break
        least = r["size"]
    carried = given.where(F.col("size") >= least).select("word", "log").toArrow()
    words = carried["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    logs = carried["log"].to_numpy()[order]
    return Vocabulary(np.array(frequent, dtype=np.int64).view(np.uint64), words[order], logs, given.where(F.col("size") < least).select("word", "log"), folder)


def encode(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, tokens, inside): the classes of all words of a text, one byte each, and their summed log P(word | class)."""
    rank = np.argsort(words.frequent)
    frequent, carried, logs = words.frequent[rank], words.carried, words.logs

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, out, inside, rare = text_column(batch, "text"), [], [], []
            for low, high in blocks(texts):
                cut = words_of(texts.slice(low, high - low), lower=True)
                hashes = cut.hashes()
                top, own = _find(hashes, frequent)
                tokens = np.where(own, 1 + rank[top], 1 + TOP + hashes % np.uint64(HASHED)).astype(np.uint8) if len(rank) else np.zeros(0, dtype=np.uint8)
                at, known = _find(hashes, carried)
                total = np.append(0.0, np.cumsum(np.where(known, logs[at], 0.0) if len(carried) else np.zeros(len(hashes))))
                open_ = np.append(0, np.cumsum(~(own | known)))
                out += [tokens[a:b].tobytes() for a, b in zip(cut.bounds[:-1].tolist(), cut.bounds[1:].tolist(), strict=True)]
                inside.append(total[cut.bounds[1:]] - total[cut.bounds[:-1]])
                rare += np.split(hashes[~(own | known)].view(np.int64), open_[cut.bounds[1:-1]])
            rows = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            inside = pa.array(np.concatenate(inside) if inside else np.zeros(0))
            yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id"), pa.array(out, pa.binary()), inside, pa.array(rare, pa.list_(pa.int64()))], ["row", "doc_id", "tokens", "inside", "rare"])

    cut = staged(docs.select("doc_id", "text").mapInArrow(run, f"row long, doc_id {dict(docs.dtypes)['doc_id']}, tokens binary, inside double, rare array<long>"), "cut", words.folder)
    # A token here has one of the lower counts, so no word is hot.
    joined = cut.select("row", F.explode("rare").alias("word")).join(words.rest, "word").groupBy("row").agg(F.sum("log").alias("_rare"))
    return cut.join(joined, "row", "left").select("doc_id", "tokens", (F.col("inside") + F.coalesce("_rare", F.lit(0.0))).alias("inside"))


def _line(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts on one line with ``SIDE`` empty places around each, the places of their tokens, and the number of tokens of each."""
    gap = bytes(SIDE)
    line = np.frombuffer(gap + gap.join(tokens) + gap, dtype=np.uint8).astype(np.intp)
    sizes = np.array([len(t) for t in tokens])
    return line, np.arange(sizes.sum()) + SIDE + np.repeat(np.arange(len(tokens)) * SIDE, sizes), sizes


def _groups(column: pa.Array, limit: int):
    """Lists of token strings of about ``limit`` tokens together; a longer text stands alone."""
    held, size = [], 0
    for x in column:
        own = x.as_py()
        if held and size + len(own) > limit:
            yield held
            held, size = [], 0
        held.append(own)
        size += len(own)
    if held:
        yield held


def train(encoded: DataFrame, folder: str) -> Network:
    """Rounds of local descent and weighted averaging over all texts."""
    model = Network.fresh()
    for turn in range(ROUNDS):
        start = model.flat()

        def descend(batches, start=start):
            own, seen, room = Network.of(start), 0, Room()
            squares = [np.zeros_like(x) for x in (own.into, own.bias, own.out, own.prior)]
            for batch in batches:
                for tokens in _groups(batch.column("tokens"), BATCH * STEPS):
                    line, places, _ = _line(tokens)
                    steps = -(-len(places) // BATCH)
                    for step in range(steps):
                        own.descend(line, places[step::steps], squares, room)
                    seen += len(places)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([seen], pa.int64()), pa.array([(own.flat().astype(np.float64) * seen).tobytes()], pa.binary())], ["slot", "seen", "weights"])

        def add(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("slot")
            total = np.sum([np.frombuffer(w, dtype=np.float64) for w in group["weights"]], axis=0)
            return pd.DataFrame({"slot": [group["slot"].iloc[0] // FAN_IN], "seen": [group["seen"].sum()], "weights": [total.tobytes()]})

        sums, depth = staged(encoded.select("tokens").mapInArrow(descend, "slot long, seen long, weights binary"), f"weights{turn}", folder), 0
        while sums.count() > FAN_IN:
            depth += 1
            sums = staged(sums.groupBy(F.expr(f"slot div {FAN_IN}")).applyInPandas(add, "slot long, seen long, weights binary"), f"weights{turn}_{depth}", folder)
        rows = sorted(sums.collect(), key=lambda r: r.slot)
        if rows:
            model = Network.of(np.sum([np.frombuffer(r.weights, dtype=np.float64) for r in rows], axis=0) / sum(r.seen for r in rows))
    return model


def score(encoded: DataFrame, model: Network) -> DataFrame:
    """(doc_id, n_tokens, pll, pll_mean): the summed conditional log-probability, and its mean (null without tokens)."""

    def run(batches):
        room = Room()
        for batch in batches:
            sums, counts = [], []
            for tokens in _groups(batch.column("tokens"), STEP):
                line, places, sizes = _line(tokens)
                logs = model.log_probability(line, places, room)
                ends = np.cumsum(sizes)
                total = np.append(0.0, np.cumsum(logs))
                sums += (total[ends] - total[ends - sizes]).tolist()
                counts += sizes.tolist()
            sums = (np.array(sums) + batch.column("inside").to_numpy()).tolist()
            mean = [s / n if n else None for s, n in zip(sums, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums, pa.float64()), pa.array(mean, pa.float64())], ["doc_id", "n_tokens", "pll", "pll_mean"])

    return encoded.mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, n_tokens long, pll double, pll_mean double")


def pseudo_likelihood(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Train on all rows of ``docs`` (doc_id, text; other columns are not read) and score each: doc_id, n_tokens, pll, pll_mean.

    A null or wordless text has no tokens, the score 0 and no mean. Repeated rows and null ids count as rows of their own. An
    empty table gives none.
    """
    small_batches(docs.sparkSession)
    folder = folder or work_dir(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    encoded = staged(encode(docs, vocabulary(docs, folder)), "tokens", folder)
    return score(encoded, train(encoded, folder))
