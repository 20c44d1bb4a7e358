"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share those turns' tokens. Sorted
by the hashes of their turns, conversations stand in depth-first order: each one emits
only the turns it does not share with its predecessor. The order is cut into
shards by range, so a first turn that a third of all conversations share
fills many tasks; a shard is a token stream of its own and repeats what its first conversation
needs from the one before. Every turn gets the position of its first token along its
conversation and the intervals of the stream its ancestors lie in, which is what its tokens may attend to.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import stored
from corpusloom.llm.packing import Encoder, Vocabulary

# The template and its control strings.
HEAD, COLON, TAIL = "### ", ": ", " </turn>\n"
TURN = re.compile(r"### ([^:]*): (.*?) </turn>\n", re.DOTALL)
ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\t"}
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
MEANING = {"\\": "\\", "h": "###", "t": "</turn>", "c": ":"}
LEARNT_ROLE = "assistant"

MADE = (
    "shard int, path int, conv_id long, turns array<long>, start long, stop long, depth int, position long, "
    "role string, learnt boolean, loss_start long, loss_stop long, ids binary, "
    "ancestors array<struct<start:long,stop:long>>"
)
NODE = ("shard", "start", "stop", "depth", "position", "role", "learnt", "loss_start", "loss_stop", "ids", "ancestors")
PATH = ("shard", "path", "conv_id", "turns")


def escape(text: str) -> str:
    for plain, safe in ESCAPES.items():
        text = text.replace(plain, safe)
    return text


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\c")


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: MEANING[m[1]], text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a formatted turn; only the body may be learnt."""
    return HEAD + escape_role(role) + COLON, escape(text), TAIL


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


class Stream:
    """One shard's token stream and the turns of the last conversation on it."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.length, self.open = encoder, 0, []

    def add(self, turns: list[tuple[str, str]]) -> list[dict]:
        """Emit what the conversation does not share; its turns are then ``open``."""
        shared = 0
        while shared < min(len(turns), len(self.open)) and self.open[shared]["turn"] == turns[shared]:
            shared += 1
        del self.open[shared:]
        fresh = []
        for turn in turns[shared:]:
            head, body, tail = (self.encoder.encode(p) for p in turn_parts(*turn))
            last = self.open[-1] if self.open else None
            size = (len(head) + len(body) + len(tail)) // 4
            node = {
                "turn": turn,
                "start": self.length,
                "stop": self.length + size,
                "depth": len(self.open),
                "position": last["position"] + last["stop"] - last["start"] if last else 0,
                "role": turn[0],
                "learnt": turn[0] == LEARNT_ROLE,
                "loss_start": self.length + len(head) // 4,
                "loss_stop": self.length + (len(head) + len(body)) // 4,
                "ids": head + body + tail,
                "ancestors": self.intervals(),
            }
            self.length += size
            self.open.append(node)
            fresh.append(node)
        return fresh

    def intervals(self) -> list[dict]:
        """Where the open turns lie, neighbours merged: what the last one saw, and itself."""
        if not self.open:
            return []
        last = self.open[-1]
        out, own = list(last["ancestors"]), {"start": last["start"], "stop": last["stop"]}
        if out and out[-1]["stop"] == own["start"]:
            own["start"] = out.pop()["start"]
        return [*out, own]


def grown(vocabulary: Vocabulary):
    names = [c.split()[0] for c in re.split(r", (?=[a-z_]+ )", MADE)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream = Stream(Encoder(vocabulary))
        shard, path = TaskContext.get().partitionId(), 0
        for rows in batches:
            out = []
            for conv, roles, texts in zip(rows["conv_id"], rows["roles"], rows["texts"]):
                for node in stream.add([(r or "", t or "") for r, t in zip(roles, texts)]):
                    out.append({**{k: node[k] for k in NODE[1:]}, "shard": shard})
                starts = [n["start"] for n in stream.open]
                own = None if pd.isna(conv) else int(conv)
                out.append({"shard": shard, "path": path, "conv_id": own, "turns": starts})
                path += 1
            frame = pd.DataFrame(out, columns=names, dtype=object)
            yield frame.where(frame.notna(), None)

    return run


def prefix_tree(
    conversations: DataFrame,
    vocabulary: Vocabulary,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    shards: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths) of all conversations.

    ``nodes`` has a row per emitted turn: where its token ``ids`` stand in the
    stream of its shard, its position, loss interval and ancestors' intervals.
    ``paths`` has a row per conversation with the stream starts of its turns.
    A conversation is one record; turns come by number, then role, then text.
    Null roles and texts are empty; a row without an id is a conversation of its own.
    """
    parts = shards or int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    said = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = conversations.select(F.col(conv).cast("long").alias("conv_id"), said.alias("turn"))
    whole = rows.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("said"))
    alone = rows.filter("conv_id is null").select("conv_id", F.array("turn").alias("said"))
    whole = whole.union(alone)
    keyed = whole.select(
        "conv_id",
        F.transform("said", lambda s: s["role"]).alias("roles"),
        F.transform("said", lambda s: s["text"]).alias("texts"),
        F.transform("said", lambda s: F.xxhash64(s["role"], s["text"])).alias("order"),
    )
    # Stored first, so that the ranges are drawn from what is then dealt out.
    keyed = stored(keyed, "conversations")
    dealt = keyed.repartitionByRange(parts, "order", "conv_id").sortWithinPartitions("order", "conv_id")
    made = stored(dealt.select("conv_id", "roles", "texts").mapInPandas(grown(vocabulary), MADE), "tree")
    return made.filter("turns is null").select(*NODE), made.filter("turns is not null").select(*PATH)


BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def reader(vocabulary: Vocabulary):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = Encoder(vocabulary).decode
        for rows in batches:
            out = []
            for conv, pieces in zip(rows["conv_id"], rows["pieces"]):
                formatted, learnt = [], []
                for piece in pieces:
                    ids = array("I", bytes(piece["ids"]))
                    formatted.append(decode(ids))
                    if piece["learnt"]:
                        a, b = (int(piece[k] - piece["start"]) for k in ("loss_start", "loss_stop"))
                        learnt.append(unescape(decode(ids[a:b])))
                text, loss = "".join(formatted), "".join(learnt)
                turns = parse(text)
                plain = "".join(f"{role}\n{said}\n" for role, said in turns)
                own = None if pd.isna(conv) else int(conv)
                digests = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (plain, loss)]
                out.append((own, len(turns), digests[0], len(loss), digests[1], len(text)))
            names = [c.split()[0] for c in BACK.split(", ")]
            yield pd.DataFrame(out, columns=names).astype({"conv_id": object})

    return run


def read_back(nodes: DataFrame, paths: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per conversation what the streams say about it: turns and learnt text, as digests."""
    steps = paths.select("shard", "path", "conv_id", F.posexplode("turns").alias("step", "start"))
    found = steps.join(nodes.select("shard", "start", "ids", "learnt", "loss_start", "loss_stop"), ["shard", "start"])
    piece = F.struct("step", "start", "ids", "learnt", "loss_start", "loss_stop")
    whole = found.groupBy("shard", "path").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(piece)).alias("pieces")
    )
    return whole.select("conv_id", "pieces").mapInPandas(reader(vocabulary), BACK)
