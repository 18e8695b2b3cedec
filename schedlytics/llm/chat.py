"""Chat formatting as prefix trees: turns that conversations share are emitted once, depth first, with positions and attention.

A node is a turn after a certain run of turns. Conversations are dealt into packs of bounded size: first by their first turn,
and where a pack is too large by the next turn, and so on, so that a first turn that very many share is repeated once per pack
and never gathers all of them. In a pack every node's formatted text stands once, in depth-first order. A node carries the
position of its first character in its conversation (position ids run on from there), the intervals of the pack that its
characters may attend to (its ancestors and itself, causally), and the interval that the loss covers.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schedlytics.llm.tables import small_batches, staged
from schedlytics.session import work_dir

# The control strings of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Characters of distinct turns that a pack is planned for.
PACK_CHARS = 1_000_000
PACKS = ("pack string, text string, nodes array<struct<start:bigint,loss_start:bigint,loss_end:bigint,end:bigint,position:bigint,attends:array<struct<start:bigint,end:bigint>>>>, "
         "leaves array<struct<path:string,node:int>>")


def escape(text: str, line: bool = False) -> str:
    """No control string is left: backslashes are doubled, ``<|`` is split by one; in a ``line`` newlines are ``\\n``."""
    text = text.replace("\\", "\\\\").replace("<|", "<\\|")
    return text.replace("\n", "\\n") if line else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


def paths_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns, keys): turns in order; key k is the digest of turns 0..k. A null role or text is empty.

    Rows of equal turn are ordered by role and text; rows with a null turn come first. Rows with a null conv_id are one conversation.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    digest = lambda before, t: F.sha2(F.concat_ws("\n", before, F.sha2(t["role"], 256), F.sha2(t["text"], 256)), 256)
    chain = F.aggregate("turns", F.array().cast("array<string>"), lambda keys, t: F.concat(keys, F.array(digest(F.coalesce(F.get(keys, F.size(keys) - 1), F.lit("")), t))))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"), chain.alias("keys"))


def dealt(paths: DataFrame, folder: str, pack_chars: int = PACK_CHARS) -> DataFrame:
    """Distinct paths (path, keys, turns, pack): packs above the planned size are split by the next turn until none is left."""
    now, depth = paths.withColumn("pack", F.lit("p")).withColumn("open", F.lit(True)), 0
    while True:
        nodes = now.where("open").select("pack", F.explode(F.arrays_zip("keys", "turns")).alias("x")).select("pack", F.col("x.keys").alias("key"), F.length("x.turns.text").alias("chars"))
        size = nodes.groupBy("pack", "key").agg(F.max("chars").alias("chars")).groupBy("pack").agg(F.sum("chars").alias("chars"))
        large = staged(size.where(F.col("chars") > 2 * pack_chars).select("pack", F.ceil(F.col("chars") / pack_chars).alias("parts")), f"large{depth}", folder)
        if large.isEmpty():
            return now.drop("open")
        split = F.concat_ws("/", "pack", F.pmod(F.xxhash64(F.get("keys", F.lit(depth))), F.col("parts")).cast("string"))
        deeper = F.col("parts").isNotNull() & (F.size("keys") > depth)
        now = now.join(large, "pack", "left").withColumn("pack", F.when(deeper, split).otherwise(F.col("pack"))).withColumn("open", deeper).drop("parts")
        now, depth = staged(now, f"packs{depth}", folder), depth + 1


def emit(group: pd.DataFrame) -> pd.DataFrame:
    """One pack: sorted by their keys, paths visit the tree depth first."""
    text, nodes, leaves, size = [], [], [], 0
    trail: list[tuple[str, int]] = []
    rows = sorted(zip([tuple(k) for k in group["keys"]], group["turns"], group["path"], strict=True), key=lambda x: x[0])
    for keys, turns, path in rows:
        shared = 0
        while shared < min(len(trail), len(keys)) and trail[shared][0] == keys[shared]:
            shared += 1
        del trail[shared:]
        for key, turn in zip(keys[shared:], turns[shared:], strict=True):
            head, body = f"{OPEN}{escape(turn['role'], line=True)}\n", escape(turn["text"])
            parent = nodes[trail[-1][1]] if trail else None
            end = size + len(head) + len(body) + len(CLOSE)
            loss = (size + len(head), size + len(head) + len(body)) if turn["role"] == "assistant" else (size, size)
            before = [dict(x) for x in parent["attends"]] if parent else []
            if before and before[-1]["end"] == size:
                before[-1]["end"] = end
            else:
                before.append({"start": size, "end": end})
            position = parent["position"] + parent["end"] - parent["start"] if parent else 0
            nodes.append({"start": size, "loss_start": loss[0], "loss_end": loss[1], "end": end, "position": position, "attends": before})
            trail.append((key, len(nodes) - 1))
            text += [head, body, CLOSE]
            size = end
        leaves.append({"path": path, "node": trail[-1][1]})
    return pd.DataFrame({"pack": [group["pack"].iloc[0]], "text": ["".join(text)], "nodes": [nodes], "leaves": [leaves]})


def format_conversations(conversations: DataFrame, folder: str | None = None, pack_chars: int = PACK_CHARS) -> tuple[DataFrame, DataFrame]:
    """(packs, members): the packs as described above, and (conv_id, path) naming each conversation's leaf.

    Equal conversations have one path. Other columns than conv_id, turn, role and text are not read. An empty table gives none.
    """
    folder = folder or work_dir(conversations.sparkSession)
    paths = staged(paths_of(conversations).withColumn("path", F.element_at("keys", -1)), "paths", folder)
    distinct = paths.groupBy("path").agg(F.first("keys").alias("keys"), F.first("turns").alias("turns"))
    packs = dealt(staged(distinct, "distinct", folder), folder, pack_chars).groupBy("pack").applyInPandas(emit, PACKS)
    return staged(packs, "packs", folder), paths.select("conv_id", "path")


def read_back(packs: DataFrame) -> DataFrame:
    """Per path of the packs, from their text and intervals alone: the digests of turns and loss, and the sizes."""
    small_batches(packs.sparkSession)
    names = ["path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    turn = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE), re.DOTALL)

    def run(batches):
        for batch in batches:
            for pack in batch.select(["text", "nodes", "leaves"]).to_pylist():
                rows, by_start = [], {n["start"]: n for n in pack["nodes"]}
                for leaf in pack["leaves"]:
                    spans = pack["nodes"][leaf["node"]]["attends"]
                    whole = "".join(pack["text"][x["start"]:x["end"]] for x in spans)
                    turns, at = [], 0
                    for m in turn.finditer(whole):
                        if m.start() != at:
                            raise ValueError("text between turns")
                        turns.append((unescape(m[1]), unescape(m[2])))
                        at = m.end()
                    if at != len(whole):
                        raise ValueError("text after the last turn")
                    inside = []
                    for x in spans:
                        here = x["start"]
                        while here < x["end"]:
                            inside.append(by_start[here])
                            here = by_start[here]["end"]
                    loss = "".join(unescape(pack["text"][n["loss_start"]:n["loss_end"]]) for n in inside)
                    told = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode("utf-8", "surrogatepass"))
                    rows.append((leaf["path"], len(turns), told.hexdigest(), len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(whole)))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return packs.mapInArrow(run, ", ".join(f"{n} {'string' if k == pa.string() else 'long'}" for n, k in zip(names, kinds, strict=True)))

