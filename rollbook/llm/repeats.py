"""Passages that repeat anywhere in the corpus, by intervals of common prefixes over a sparse suffix array.

Two equal strings of ``least`` bytes choose the same anchor: the k-byte piece with the least hash in them. So it
is enough to compare suffixes that start at anchors, and only those whose anchor piece occurs twice.

1. Tasks lay texts end to end as runs, find the anchors and hash each anchor's context: as many bytes to both
   sides as a string of ``least`` bytes around the anchor can reach, ended by the document.
2. Hashes meet in radix parts, once per run; the runs learn which of their anchors are shared. Equal contexts are
   one class with a count from here on, so a passage that a third of all documents hold is a few classes.
3. Distinct contexts of a shared anchor go to one task. Their right sides, in order, are an enhanced suffix array;
   a scan with a stack gives the tree of its common-prefix intervals. The members of an interval agree on r bytes
   to the right. In the order of their left sides, neighbours that agree on l bytes with l + r >= ``least`` repeat
   each other; a left interval whose members lie in several children is a repeat that cannot grow to either side.
4. Each occurrence of a class is covered as far as its best partners reach; the runs cut covered bytes out.

Runs are in a table bucketed by run, so what is learned about them is joined without shuffling any text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.shared import arrow_rows, written
from rollbook.llm.shingles import mix
from rollbook.session import shared_folder

#: Bytes after which a run ends; a longer text is a run of its own.
RUN_BYTES = 1 << 22
#: Window starts that are looked at together.
BLOCK = 1 << 17
#: Contexts that are sorted together, and members of intervals that are compared together.
SORTED, COMPARED = 1 << 15, 1 << 16
#: Contexts of one anchor that go to one task; more are compared by the hashes of their strings instead.
MOST = 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def piece_bytes(least: int) -> int:
    """k: the largest power of two up to half of ``least``."""
    if least < 16:
        raise ValueError("repeats have 16 bytes at least")
    return 1 << ((least // 2).bit_length() - 1)


def piece_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k bytes, by doubling."""
    h = data.astype(np.uint64)
    for s in (1, 2, 4):
        h = h[:-s] | (h[s:] << np.uint64(8 * s))
    h = mix(h)
    size = 8
    while size < k:
        h = mix(h[:-size] * _ODD + h[size:])
        size *= 2
    return h


def windowed_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, and random words for bytes stand behind them."""
    out = []
    for base in (int(_ODD), pow(int(_ODD), -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


_WORDS = np.random.Generator(np.random.PCG64(13)).integers(1, 2**63, 256, dtype=np.uint64)


def anchors(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash, context hash) of the anchors of all strings of ``least`` bytes within a document.

    Of equal least hashes in a string the last counts, so the choice depends on the string alone.
    """
    k, n = piece_bytes(least), len(data)
    starts = np.concatenate(([0], ends[:-1]))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))]
    for lo in range(0, n - least + 1, BLOCK):
        hi = min(n, lo + BLOCK + least - 1)
        h = piece_hashes(data[lo:hi], k)
        order = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
        at = (_LOW - (windowed_min(order, least - k + 1) & _LOW)).astype(np.int64)
        window = np.arange(lo, lo + len(at))
        at = np.unique(at[window + least <= ends[np.searchsorted(ends, window, "right")]])
        if not len(at):
            continue
        place = at + lo
        doc = np.searchsorted(ends, place, "right")
        left, right = np.maximum(place - (least - k), starts[doc]), np.minimum(place + least, ends[doc])
        base, top = int(left.min()), int(right.max())
        up, down = _powers(BLOCK + 4 * least)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_WORDS[data[base:top]] * up[: top - base], dtype=np.uint64)))
        context = (sums[right - base] - sums[left - base]) * down[left - base]
        context = mix(mix(context + (place - left).astype(np.uint64)) + (right - place).astype(np.uint64) * _ODD)
        # Anchors have small hashes; mixed once more they spread over all values.
        found.append((place, mix(h[at] + _ODD), context))
    place, h, context = (np.concatenate(x) for x in zip(*found, strict=True))
    place, first = np.unique(place, return_index=True)
    return place, h[first], context[first]


_RUN = pa.schema([("run", pa.int64()), ("ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("bytes", pa.binary()), ("at", pa.list_(pa.int64())), ("hashes", pa.binary()), ("contexts", pa.binary())])
_RUN_DDL = "run long, ids array<long>, ends array<long>, bytes binary, at array<long>, hashes binary, contexts binary"


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _numbers(column: pa.Array) -> Iterator[np.ndarray]:
    """Lists of numbers, row by row, without making objects of them."""
    flat, cuts = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    cuts = cuts - cuts[0]
    yield from (flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def _structs(column: pa.Array, *fields: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Lists of structs, row by row, as an array for each field; a missing list is empty."""
    flat, rows = column.flatten(), column.value_lengths().fill_null(0).to_numpy()
    parts = [flat.field(f).to_numpy(zero_copy_only=False) for f in fields]
    cuts = np.concatenate(([0], np.cumsum(rows)))
    yield from (tuple(p[a:b] for p in parts) for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def _runs(least: int):
    """For mapInArrow over (id, bytes of the text)."""

    def made(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        whole = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        place, h, context = anchors(np.frombuffer(whole, np.uint8), ends, least)
        return _batch(_RUN, [number], [ids], [ends], [zstandard.ZstdCompressor(level=3).compress(whole)], [place], [h.tobytes()], [context.tobytes()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(key)
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size >= RUN_BYTES:
                    yield made(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield made(number, ids, texts)

    return run


_PART = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("hashes", pa.binary())])
_PART_DDL = "run long, radix int, hashes binary"


def _deal(parts: int):
    """For mapInArrow over (run, hashes): the run's distinct hashes by radix; what the run holds twice, twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h, n = np.unique(np.frombuffer(held, np.uint64), return_counts=True)
                h = np.repeat(h, np.minimum(n, 2))
                cuts = np.searchsorted(h, [np.uint64((r << 64) // parts) for r in range(parts)]).tolist() + [len(h)]
                some = [r for r in range(parts) if cuts[r] < cuts[r + 1]]
                yield _batch(_PART, [number] * len(some), some, [h[cuts[r] : cuts[r + 1]].tobytes() for r in some])

    return run


def _among(values: np.ndarray, rising: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(rising):
        return np.zeros(len(values), bool)
    return rising[np.minimum(np.searchsorted(rising, values), len(rising) - 1)] == values


def _shared(table: pa.Table) -> pa.Table:
    """Of all hashes of a radix, those that occur twice, for each run that has some."""
    held = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    h, n = np.unique(np.concatenate(held), return_counts=True)
    twice = h[n > 1]
    told = [np.unique(x[_among(x, twice)]).tobytes() for x in held]
    return pa.Table.from_arrays([table.column("run").combine_chunks(), table.column("radix").combine_chunks(), pa.array(told, pa.binary())], schema=_PART)


_HELD = pa.schema([("run", pa.int64()), ("nth", pa.int32()), ("hash", pa.int64()), ("context", pa.int64())])


def _hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, hashes, contexts, shared): a row for each anchor whose hash is shared."""
    for batch in batches:
        for number, hashes, contexts, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            h, c = np.frombuffer(hashes, np.int64), np.frombuffer(contexts, np.int64)
            nth = np.flatnonzero(_among(h, np.sort(np.frombuffer(b"".join(shared), np.int64))))
            yield _batch(_HELD, np.full(len(nth), number), nth, h[nth], c[nth])


_CUT = pa.schema([("hash", pa.int64()), ("context", pa.int64()), ("own", pa.bool_()), ("large", pa.bool_()), ("before", pa.binary()), ("after", pa.binary())])
_CUT_DDL = "hash long, context long, own boolean, large boolean, before binary, after binary"


def _reaches(place: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of the context of each anchor."""
    starts, doc = np.concatenate(([0], ends[:-1])), np.searchsorted(ends, place, "right")
    return np.maximum(place - (least - piece_bytes(least)), starts[doc]), np.minimum(place + least, ends[doc])


def _cut_out(least: int):
    """For mapInArrow over (ends, bytes, at, asked): the contexts that are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends_, packed_, at_, asked_ = batch.columns
            asked_ = _structs(asked_, "nth", "hash", "context", "own", "large")
            for ends, packed, at, (nth, *columns) in zip(_numbers(ends_), packed_, _numbers(at_), asked_, strict=True):
                data = zstandard.ZstdDecompressor().decompress(packed.as_py())
                place = at[nth]
                left, right = _reaches(place, ends, least)
                for lo in range(0, len(nth), 4096):
                    some = slice(lo, lo + 4096)
                    texts = [(data[a:p], data[p:b]) for a, p, b in zip(left[some].tolist(), place[some].tolist(), right[some].tolist(), strict=True)]
                    yield _batch(_CUT, *(c[some] for c in columns), [t[0] for t in texts], [t[1] for t in texts])

    return run


def _matrix(texts: list[bytes], width: int, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of ``width`` bytes filled with zeros, and their lengths."""
    lengths = np.array([len(t) for t in texts], np.int64)
    flat = b"".join((t[::-1] if backwards else t).ljust(width, b"\0") for t in texts)
    return np.frombuffer(flat, np.uint8).reshape(len(texts), width), lengths


def common(rows: np.ndarray, lengths: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many first bytes two rows share; a text that ends shares no more."""
    out = np.empty(len(one), np.int64)
    for lo in range(0, len(one), COMPARED):
        a, b = one[lo : lo + COMPARED], other[lo : lo + COMPARED]
        differ = rows[a] != rows[b]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[lo : lo + COMPARED] = np.minimum(first, np.minimum(lengths[a], lengths[b]))
    return out


def in_order(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows by their bytes; of rows that one text begins, the shorter text comes first."""
    return np.lexsort((lengths, np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()))


def intervals(shared: np.ndarray, least: int) -> np.ndarray:
    """(value, first, last) of all intervals of a sorted list whose neighbours share ``least`` or more.

    ``shared[i]`` is what entry i shares with the one before. An interval is a longest stretch of entries that
    share ``value`` with each other; all of them form a tree, found in one scan with a stack.
    """
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    values = shared.tolist()
    for i in range(1, len(values) + 1):
        now = values[i] if i < len(values) else 0
        if now < least:
            now = 0
        first = i - 1
        while stack and stack[-1][0] > now:
            value, first = stack.pop()
            out.append((value, first, i - 1))
        if now and (not stack or stack[-1][0] < now):
            stack.append((now, first))
    return np.array(out, np.int64).reshape(-1, 3)


class Contexts:
    """The enhanced suffix array of the right sides of some contexts, with their left sides beside it."""

    def __init__(self, before: list[bytes], after: list[bytes], least: int):
        self.least, self.k = least, piece_bytes(least)
        self.right, self.right_length = _matrix(after, least)
        self.left, self.left_length = _matrix(before, least - self.k, backwards=True)
        self.order = in_order(self.right, self.right_length)
        self.shared = np.concatenate(([0], common(self.right, self.right_length, self.order[1:], self.order[:-1])))
        self.rank = np.empty(len(before), np.int64)
        self.rank[in_order(self.left, self.left_length)] = np.arange(len(before))

    def members(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For some intervals at a time, members by interval and left side: interval's r, member, child, l shared with the one before (-1 at the first)."""
        nodes = intervals(self.shared, self.k)
        sizes = nodes[:, 2] - nodes[:, 1] + 1
        group = np.cumsum(sizes) // COMPARED
        for cut in np.split(np.arange(len(nodes)), np.flatnonzero(np.diff(group)) + 1):
            if not len(cut):
                continue
            size, first = sizes[cut], nodes[cut, 1]
            node = np.repeat(np.arange(len(cut)), size)
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - first, size)
            r = nodes[cut, 0][node]
            child = np.cumsum((self.shared[at] == r) | (at == first[node]))
            member = self.order[at]
            by = np.lexsort((self.rank[member], node))
            node, member, r, child = node[by], member[by], r[by], child[by]
            same = np.flatnonzero(node[1:] == node[:-1]) + 1
            left = np.full(len(node), -1)
            left[same] = common(self.left, self.left_length, member[same], member[same - 1])
            yield r, member, child, left

    def reach(self) -> tuple[np.ndarray, np.ndarray]:
        """How far to the left and right of its anchor each context repeats another; 0 and 0 where it doesn't."""
        reached = [np.zeros(len(self.order), np.int64) for _ in range(2)]
        for r, member, _, left in self.members():
            best = np.maximum(left, np.append(left[1:], -1))
            ok = best + r >= self.least
            np.maximum.at(reached[0], member[ok], best[ok])
            np.maximum.at(reached[1], member[ok], r[ok])
        return reached[0], reached[1]

    def groups(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(l, r, members) of each repeat of ``least`` bytes or more that can grow to neither side within the contexts."""
        for r, member, child, left in self.members():
            both = np.where(left < 0, 0, left + r)
            for value, a, b in intervals(both, self.least):
                inside = slice(a, b + 1)
                if child[inside].min() != child[inside].max():  # else they share more to the right, in one child
                    yield value - r[a], r[a], member[inside]


_REACH = pa.schema([("hash", pa.int64()), ("context", pa.int64()), ("left", pa.int32()), ("right", pa.int32())])
_REACH_DDL = "hash long, context long, left int, right int"
_GROUP = pa.schema([("repeat", pa.int64()), ("hash", pa.int64()), ("context", pa.int64()), ("left", pa.int32()), ("right", pa.int32())])


def _by_anchor(least: int, solve):
    """For mapInArrow over contexts that rise by hash: whole anchors, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            kept.append(batch)
            rows += batch.num_rows
            if rows < SORTED:
                continue
            table = pa.Table.from_batches(kept)
            h = table.column("hash").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
            if cut:
                yield from solve(table.slice(0, cut), least)
                kept = table.slice(cut).combine_chunks().to_batches()
                rows = table.num_rows - cut
        if rows:
            yield from solve(pa.Table.from_batches(kept), least)

    return run


def _reach(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    left, right = Contexts(table.column("before").to_pylist(), table.column("after").to_pylist(), least).reach()
    ok = np.flatnonzero((right > 0) & ~table.column("own").to_numpy())
    yield _batch(_REACH, table.column("hash").to_numpy()[ok], table.column("context").to_numpy()[ok], left[ok], right[ok])


def _groups(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    h, context = (table.column(c).to_numpy() for c in ("hash", "context"))
    for left, right, members in Contexts(table.column("before").to_pylist(), table.column("after").to_pylist(), least).groups():
        n = len(members)
        # Named by the anchor, what is shared and its least context.
        name = mix(h[members[:1]].view(np.uint64) + mix(context[members].min(keepdims=True).view(np.uint64)) * np.uint64(2 * left + 1) + np.uint64(right)).view(np.int64)
        yield _batch(_GROUP, np.repeat(name, n), h[members], context[members], np.full(n, left), np.full(n, right))


_OUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _remove(least: int, with_text: bool):
    """For mapInArrow over (ids, ends, bytes, at, spans): a row for each document."""

    def covered(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which of n bytes lie in one of the spans."""
        gone, order = np.zeros(n, bool), np.argsort(first, kind="stable")
        first, end = first[order], np.maximum.accumulate(end[order]) if len(end) else end
        opens = np.flatnonzero(np.concatenate(([True], first[1:] > end[:-1]))) if len(first) else []
        for a, b in zip(first[opens], end[np.append(opens[1:] - 1, len(end) - 1)] if len(first) else [], strict=True):
            gone[a:b] = True
        return gone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_, ends_, packed_, at_, spans_ = batch.columns
            for ids, ends, packed, at, (nth, left, right) in zip(ids_, _numbers(ends_), packed_, _numbers(at_), _structs(spans_, "nth", "left", "right"), strict=True):
                data, place = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_py()), np.uint8), at[nth]
                first, end = _reaches(place, ends, least)
                first, end = np.where(left < 0, first, place - left), np.where(left < 0, end, place + right)
                ok = end - first >= least
                gone = covered(len(data), first[ok], end[ok])
                rows = []
                for key, a, b in zip(ids.as_py(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    cut = gone[a:b]
                    kept = data[a:b][~cut].tobytes()
                    runs = int(cut[:1].sum()) + int((cut[1:] & ~cut[:-1]).sum())
                    rows.append((key, b - a, int(cut.sum()), runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None))
                yield _batch(_OUT, *zip(*rows, strict=True))

    return run


def _bucketed(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder, in buckets of ``key``, so that joins on it don't shuffle it."""
    spark, name = df.sparkSession, f"{purpose}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", shared_folder(spark, purpose)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the frame knows its files and buckets; the name leaves the catalog, the files stay
    return table


class Corpus:
    """What all results need: the runs, the anchors that are shared and their classes."""

    def __init__(self, docs: DataFrame, id: str, text: str, least: int, part_anchors: int):
        self.least = least
        piece_bytes(least)
        with arrow_rows(docs.sparkSession, 512):
            read = docs.select(F.col(id).cast("long").alias("id"), F.encode(F.col(text), "UTF-8").alias("bytes"))
            self.runs = _bucketed(read.mapInArrow(_runs(least), _RUN_DDL), "run", "repeats")
        n = self.runs.agg(F.sum(F.size("at"))).first()[0] or 0
        parts = max(1, -(-n // part_anchors))
        pieces = self.runs.select("run", "hashes").mapInArrow(_deal(parts), _PART_DDL)
        shared = pieces.repartition(parts, "radix").groupBy("radix").applyInArrow(_shared, _PART_DDL).groupBy("run").agg(F.collect_list("hashes").alias("shared"))
        held = self.learned(shared, "inner").select("run", "hashes", "contexts", "shared").mapInArrow(_hold, "run long, nth int, hash long, context long")
        with arrow_rows(docs.sparkSession, 4):  # rows are whole runs
            self.held = written(held, "repeats-held")
        self.classes = written(
            self.held.groupBy("hash", "context").agg(F.count("*").alias("n"), F.min(F.struct("run", "nth")).alias("first")), "repeats-classes"
        )

    def learned(self, about: DataFrame, how: str) -> DataFrame:
        """The runs with what is known about them; the small side is the one that is hashed."""
        return self.runs.join(about.hint("shuffle_hash"), "run", how)

    def contexts(self, most: int) -> tuple[DataFrame, bool]:
        """The distinct contexts of anchors that have several, as bytes; whether some anchor has more than ``most``."""
        several = written(self.classes.groupBy("hash").agg(F.count("*").alias("contexts")).where("contexts > 1"), "repeats-several")
        asked = self.classes.join(several, "hash").select(
            F.col("first.run").alias("run"),
            F.struct(F.col("first.nth").alias("nth"), "hash", "context", F.expr("n > 1").alias("own"), (F.col("contexts") > most).alias("large")).alias("asked"),
        )
        lists = asked.groupBy("run").agg(F.collect_list("asked").alias("asked"))
        cut = self.learned(lists, "inner").select("ends", "bytes", "at", "asked").mapInArrow(_cut_out(self.least), _CUT_DDL)
        with arrow_rows(several.sparkSession, 4):
            cut = written(cut, "repeats-contexts")
        return cut, not several.where(F.col("contexts") > most).isEmpty()


def _solved(contexts: DataFrame, solve, least: int, schema: str) -> DataFrame:
    return contexts.repartition("hash").sortWithinPartitions("hash").mapInArrow(_by_anchor(least, solve), schema)


def _reach_by_strings(contexts: DataFrame, least: int) -> DataFrame:
    """(hash, context, left, right) for anchors with any number of contexts: equal strings around the anchor are counted."""
    at, size = F.octet_length("before"), F.lit(least)
    offsets = F.explode(F.sequence(F.lit(0), F.lit(least - piece_bytes(least))))
    placed = contexts.select("hash", "context", "own", F.concat("before", "after").alias("b"), at.alias("at"), offsets.alias("o"))
    placed = placed.where("o <= at AND octet_length(b) - at >= %d - o" % least)
    strings = written(placed.select("hash", "context", "own", "o", F.xxhash64(F.substring("b", F.col("at") - F.col("o") + 1, size)).alias("w")), "repeats-strings")
    twice = written(strings.groupBy("hash", "o", "w").agg(F.sum(F.expr("if(own, 2, 1)")).alias("n")).where("n > 1").drop("n"), "repeats-twice")
    return strings.where("NOT own").join(twice.hint("merge"), ["hash", "o", "w"]).groupBy("hash", "context").agg(
        F.max("o").cast("int").alias("left"), (size - F.min("o")).cast("int").alias("right")
    )


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 200, with_text: bool = False, part_anchors: int = 1 << 18, most: int = MOST
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and the ``kept`` text if wanted.

    Removed is each UTF-8 byte covered by a string of ``least`` bytes that also starts anywhere else in the corpus,
    the same document included (overlaps count). Strings don't cross documents and are judged on the input. ``kept``
    leaves out bytes of a character that was cut; the digest has all. Rows that repeat a text are copies of each
    other, also when they repeat an id or have none. Null and empty texts have no bytes. An empty table gives no
    rows; other columns play no part. Hashes of anchors and contexts have 64 bits; collisions are not followed up.

    ``part_anchors`` bounds the hashes of a radix part and ``most`` the contexts of an anchor that are sorted in one
    task; contexts of anchors beyond it are compared by the hashes of their strings, with the same result.
    """
    corpus = Corpus(docs, id, text, least, part_anchors)
    contexts, large = corpus.contexts(most)
    found = _solved(contexts.where("NOT large"), _reach, least, _REACH_DDL)
    if large:
        found = found.union(_reach_by_strings(contexts.where("large"), least))
    # Contexts that occur twice repeat as far as they go.
    whole = corpus.classes.where("n > 1").select("hash", "context", F.lit(-1).alias("left"), F.lit(-1).alias("right"))
    reach = written(whole.union(found), "repeats-reach")
    spans = corpus.held.join(reach.hint("merge"), ["hash", "context"]).groupBy("run").agg(F.collect_list(F.struct("nth", "left", "right")).alias("spans"))
    with arrow_rows(docs.sparkSession, 2):
        rows = corpus.learned(spans, "left").select("ids", "ends", "bytes", "at", "spans")
        out = rows.mapInArrow(_remove(least, with_text), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
        out = written(out, "repeats-out")
    return (out if with_text else out.drop("kept")).withColumnRenamed("id", id)


def repeat_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 200, part_anchors: int = 1 << 18) -> DataFrame:
    """Repeats with all their occurrences: repeat, id, start, length (bytes of the document).

    A repeat is a string of ``least`` bytes or more around an anchor that occurs at several places and grows to
    neither side without losing one of them, as far as contexts reach. Contexts that occur several times are
    a repeat as a whole. Rows of equal ``repeat`` belong together.
    """
    corpus = Corpus(docs, id, text, least, part_anchors)
    contexts, _ = corpus.contexts(MOST)
    schema = "repeat long, hash long, context long, left int, right int"
    found = _solved(contexts, _groups, least, schema)
    whole = corpus.classes.where("n > 1").select(F.xxhash64("hash", "context").alias("repeat"), "hash", "context", F.lit(-1).alias("left"), F.lit(-1).alias("right"))
    members = written(whole.union(found), "repeats-groups")
    spans = corpus.held.join(members.hint("merge"), ["hash", "context"]).groupBy("run").agg(F.collect_list(F.struct("nth", "left", "right", "repeat")).alias("spans"))
    rows = corpus.learned(spans, "inner").select("ids", "ends", "at", "spans")
    return rows.mapInArrow(_occurrences(least), "repeat long, id long, start long, length long").withColumnRenamed("id", id)


def _occurrences(least: int):
    schema = pa.schema([(n, pa.int64()) for n in ("repeat", "id", "start", "length")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_, ends_, at_, spans_ = batch.columns
            for ids, ends, at, (nth, left, right, repeat) in zip(ids_, _numbers(ends_), _numbers(at_), _structs(spans_, "nth", "left", "right", "repeat"), strict=True):
                place = at[nth]
                first, end = _reaches(place, ends, least)
                first, end = np.where(left < 0, first, place - left), np.where(left < 0, end, place + right)
                doc = np.searchsorted(ends, place, "right")
                start = first - np.concatenate(([0], ends[:-1]))[doc]
                ok = np.flatnonzero(end - first >= least)
                ids = ids.as_py()
                yield _batch(schema, repeat[ok], [ids[d] for d in doc[ok]], start[ok], (end - first)[ok])

    return run
