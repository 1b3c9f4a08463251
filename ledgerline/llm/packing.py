"""Best-fit packing by minimum bin slack over the histogram of piece lengths."""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize


@lru_cache(maxsize=1)
def _encoder(vocabulary: str, ranks: str | None):
    """A function text -> ids like tokenizers' encode(add_special_tokens=False) of the vocabulary file, loaded once in each worker process.

    With the same vocabulary as ranks, the texts go through tiktoken, which gives the same ids several times faster; texts with
    the string of a special token always go through tokenizers.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary)
    plain = lambda t: own.encode(t, add_special_tokens=False).ids
    if ranks is None:
        return plain
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        held = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=held, special_tokens={})
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    return lambda t: plain(t) if any(s in t for s in special) else fast.encode_ordinary(t)


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None, length: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Token pieces of all documents: (doc_id, piece, start, length, ids_crc32[, ids]).

    A document is its ids and then `end_id`; null text is empty and gives that id alone. Documents of more than
    `length` ids are cut in pieces of `length`, the first one takes the rest.
    """

    def cut(batches):
        encode = _encoder(vocabulary, ranks)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            ids_of = batch.column(batch.schema.get_field_index("doc_id"))
            texts = batch.column(batch.schema.get_field_index("text"))
            for i in range(batch.num_rows):
                ids = np.array([*encode(texts[i].as_py() or ""), end_id], "<u4")
                first = (len(ids) - 1) % length + 1
                for k, begin in enumerate([0, *range(first, len(ids), length)]):
                    part = ids[begin : first if k == 0 else begin + length]
                    for col, v in zip(out, (ids_of[i].as_py(), k, begin, len(part), zlib.crc32(part.tobytes()), part.tolist() if with_ids else None), strict=True):
                        col.append(v)
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *[pa.array(c, pa.int64()) for c in out[2:5]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(out[5], pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, with repeats as far as the counts go, whose sum is the largest one of at most `room`.

    Subset sums as bits of an integer: bit s is set if s can be reached. The layers are kept to walk back. Long
    lengths come first, so that short ones stay for later bins; it ends as soon as the room is filled.
    """
    layers, reach, mask = [(0, 0, 1)], 1, (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        n, step = min(counts[length], room // length), 1
        while n > 0 and not reach >> room & 1:
            take = min(step, n)
            reach |= reach << take * length & mask
            layers.append((take, length, reach))
            n, step = n - take, step * 2
        if reach >> room & 1:
            break
    best, chosen = reach.bit_length() - 1, []
    for k in range(len(layers) - 1, 0, -1):
        take, length, _ = layers[k]
        if not layers[k - 1][2] >> best & 1:
            chosen += [length] * take
            best -= take * length
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Patterns (times, lengths) that use up the counts. Each pattern takes the largest length left and the fullest
    feasible combination with it, as often as the counts allow, so the patterns do not grow with the pieces."""
    counts = {k: v for k, v in counts.items() if v > 0}
    found = []
    while counts:
        top = max(counts)
        counts[top] -= 1
        lengths = [top, *fullest(counts, capacity - top)]
        counts[top] += 1
        used: dict[int, int] = {}
        for x in lengths:
            used[x] = used.get(x, 0) + 1
        times = min(counts[x] // n for x, n in used.items())
        found.append((times, lengths))
        for x, n in used.items():
            counts[x] -= times * n
            if not counts[x]:
                del counts[x]
    return found


def pack(pieces_: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset (place in the sequence, gapless from 0) to pieces; rows with equal keys are packed each.

    Only the histogram of lengths (at most `capacity` rows) comes to the driver, where minimum bin slack turns it into
    patterns, a few for each distinct length at most. Pieces of one length are alike: each one gets its rank among them
    (ranks run over salted buckets with offsets, so a length that holds a third of all pieces is no single task) and
    the patterns give that rank its sequence and place. An empty table gives no rows.
    """
    spark = pieces_.sparkSession
    held = materialize(pieces_.withColumn("_r", F.monotonically_increasing_id()))
    n = held.count()
    buckets = max(64, n // 200_000)
    held = held.withColumn("_b", F.pmod(F.xxhash64("_r"), F.lit(buckets)).cast("int"))
    sizes = held.groupBy("length", "_b").count()
    counts = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("count")).collect()}
    begin = sizes.select("length", "_b", (F.sum("count").over(Window.partitionBy("length").orderBy("_b")) - F.col("count")).alias("_begin"))
    rank = F.row_number().over(Window.partitionBy("length", "_b").orderBy("_r")) - 1
    ranked = held.withColumn("_i", rank).join(begin, ["length", "_b"]).withColumn("_rank", F.col("_begin") + F.col("_i"))
    # For each length, in order: first rank, first sequence, pieces a sequence, offset of the first of them.
    plan: dict[int, list[tuple[int, int, int, int]]] = {}
    given, sequence = dict.fromkeys(counts, 0), 0
    for times, lengths in minimum_bin_slack(counts, capacity):
        offset = 0
        for x in sorted(set(lengths), reverse=True):
            m = lengths.count(x)
            plan.setdefault(x, []).append((given[x], sequence, m, offset))
            given[x] += times * m
            offset += m * x
        sequence += times
    shared = spark.sparkContext.broadcast({x: np.array(v, np.int64) for x, v in plan.items()})

    def place(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "_rank"))
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at, own = np.flatnonzero(length == x), shared.value[int(x)]
                row = own[np.searchsorted(own[:, 0], rank[at], "right") - 1]
                inside = rank[at] - row[:, 0]
                seq[at], off[at] = row[:, 1] + inside // row[:, 2], row[:, 3] + inside % row[:, 2] * x
            names = [c for c in batch.schema.names if c not in ("_rank", "_i", "_begin", "_b", "_r")]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in names], pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    names = pieces_.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces_.schema) + ", sequence_id long, offset long"
    return ranked.select(*names, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, length: int = 2048) -> DataFrame:
    """Cut and pack documents with the public byte-level vocabulary.

    Null and empty texts are one piece of one token, the closing id 0. Very long texts are cut whole, in pieces of
    `length`, of which the first may be shorter. Repeated rows are packed each; pieces of one length may change places; no rows
    give none; extra columns are not read.
    """
    import public_tokenizers

    return pack(pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), length), length)
