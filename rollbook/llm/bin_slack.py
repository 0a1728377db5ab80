"""Best-fit packing of token sequences by minimum bin slack.

Texts are tokenized and cut in Spark; what reaches the driver is the number of pieces of each length, at
most one row per token of capacity. There each bin is filled as full as the lengths that remain allow: the
longest piece first, and beside it the fullest sum that a bitset of reachable sums finds. The combination
found is taken out as often as its lengths last. Spark then gives the n-th piece of a length its place.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.shared import arrow_rows, written


def fullest(room: int, counts: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """How many of which lengths fill ``room`` best; longer ones are preferred (``lengths`` descend).

    Bit s of ``reach`` says that some allowed pieces sum to s. A length of which k pieces remain is added
    in doubling steps, so that every number of copies up to k is reachable.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        left = min(counts[length], room // length)
        if not left:
            continue
        steps.append((length, left, reach))
        take = 1
        while left:
            take = min(take, left)
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach >> room:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, left, before in reversed(steps):
        copies = 0
        while not before >> at & 1:
            at -= length
            copies += 1
        if copies:
            chosen[length] = copies
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pieces of each length in a bin, number of such bins), until no piece is left."""
    counts = {n: c for n, c in counts.items() if c}
    out, lengths = [], sorted(counts, reverse=True)
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        bin_ = fullest(capacity - seed, counts, lengths) if seed < capacity else {}
        counts[seed] += 1
        bin_[seed] = bin_.get(seed, 0) + 1
        times = min(counts[n] // k for n, k in bin_.items())
        for n, k in bin_.items():
            counts[n] -= k * times
        out.append((bin_, times))
        lengths = [n for n in lengths if counts[n]]
    return out


def places(found: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, copies in a bin, first bin, offset in the bin), by first rank."""
    rows: dict[int, list] = {}
    taken: dict[int, int] = {}
    first = 0
    for bin_, times in found:
        offset = 0
        for n in sorted(bin_, reverse=True):
            k = bin_[n]
            rows.setdefault(n, []).append((taken.get(n, 0), k, first, offset))
            taken[n] = taken.get(n, 0) + k * times
            offset += n * k
        first += times
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


class Encoder:
    """Ids of a public byte-level BPE.

    The tokenizers library is the standard. Texts of the first 256 code points go through tiktoken with
    the same vocabulary, which gives the same ids there (tested over that range) four times as fast.
    """

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str):
        self.json_path, self.fast = json_path, None
        if ranks_path:
            import base64
            import json

            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            with open(json_path, encoding="utf-8") as file:
                special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
            self.fast = tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    @functools.cached_property
    def standard(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json_path)

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                text.encode("latin-1")
                return self.fast.encode(text, allowed_special="all")
            except UnicodeEncodeError:
                pass
        return self.standard.encode(text, add_special_tokens=False).ids


def public_encoder() -> Encoder:
    import public_tokenizers as public

    return Encoder(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def _cut(capacity: int, end: int, encoder, with_ids: bool):
    """For mapInArrow: (id, text) to pieces; ``seq`` numbers the pieces of a length within the task."""
    fields = [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("part", pa.int32()), ("seq", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows: list[tuple] = []
                some = batch.slice(lo, 256)
                for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), end], dtype="<u4")
                    first = len(ids) % capacity or capacity
                    bounds = [0, *range(first, len(ids), capacity), len(ids)]
                    for piece, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                        cut = ids[a:b]
                        row = (key, piece, a, b - a, zlib.crc32(cut.tobytes()), part, int(seen[b - a]))
                        rows.append((*row, cut.astype(np.int32)) if with_ids else row)
                        seen[b - a] += 1
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run, ", ".join(f"{n} {'array<int>' if pa.types.is_list(t) else 'int' if t == pa.int32() else 'long'}" for n, t in fields)


def _place(at: dict[int, np.ndarray], names: list[str]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rank, length = frame["rank"].to_numpy(), frame["length"].to_numpy()
            sequence, offset = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
            for n in np.unique(length):
                mine = length == n
                table = at[int(n)]
                row = table[np.searchsorted(table[:, 0], rank[mine], "right") - 1]
                nth = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 2] + nth // row[:, 1]
                offset[mine] = row[:, 3] + nth % row[:, 1] * n
            yield frame.assign(sequence_id=sequence, offset=offset)[names]

    return run


def pack(
    docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = 1024, end: int = 2, encoder=public_encoder, with_ids: bool = False
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset, and ids if wanted.

    A document is its ids and then ``end``; null text counts as empty. Documents longer than ``capacity``
    are cut into pieces of ``capacity``, of which the first takes the rest. Pieces of a sequence follow
    each other from offset 0 without gaps. Every row is packed, also rows that repeat or have no id; an
    empty table gives no rows. ``encoder`` makes, in a task, a function from text to ids.

    The pieces table is written before it is counted, so numbers within a task are final. To the driver
    go as many counts as there are lengths, at most ``capacity``; the plan that comes back has a few rows
    per length. Pieces of one length are numbered by (task, number in task), so a length that a third of
    all documents share is as spread as any.
    """
    run, kinds = _cut(capacity, end, encoder, with_ids)
    with arrow_rows(docs.sparkSession, 512):
        pieces = written(docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, kinds), "pack-pieces")
    parts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("pieces")), "pack-counts")
    totals = {r["length"]: r["pieces"] for r in parts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    at = places(patterns(totals, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", "length", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before"))
    names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    kinds = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    # Counts per task and length grow with the tasks, so they are not broadcast.
    ranked = pieces.join(before.hint("merge"), ["part", "length"]).withColumn("rank", F.col("before") + F.col("seq"))
    return ranked.mapInPandas(_place(at, names), kinds).withColumnRenamed("id", id)
