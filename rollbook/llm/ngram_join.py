"""Exact Jaccard join of word n-gram sets, down to one class id per document, with a prefix tree.

1. Each text becomes a sorted set of 64-bit shingle hashes; equal sets are one node.
2. Two sets of Jaccard likeness p/100 or more differ in at most H = (100-p)/(100+p) of their joint size.
   Dealt into H + 1 parts by hash, they agree on one part at least. So each set is signed once per part
   (for its own size class and the next lower one), and sets that can link meet on a signature. Texts that
   only share a passage rarely agree on a whole part, so a frequent passage gathers no group.
3. Sets that meet, directly or over others, form a group; no link leaves a group. Groups are cut by size, into
   ranges that double twice: a set is in the range of its size, and in the next if it could link there.
4. Texts that are half alike meet too, so a group may be far from one class. It is parted by sketches, a bit or
   some for each shingle: a sketch has the parities of the shingles dealt to its bits, so two of them differ in no
   more bits than their sets do in shingles. Pairs whose sketches differ in more than a link allows are no links; what hangs
   together by the other pairs stays a group, and sets left alone are sent nowhere.
5. Each other set is sent to its group, where a prefix tree over one token order finds the links: paths share overlaps,
   subtrees are left when the lengths that remain cannot reach the likeness, or when all below is linked already.
6. A group that exceeds a memory bound is dealt into blocks. Some of its sets, the hubs, go to every block and
   join what is alike over all blocks; then only sets outside the largest class so found meet the other blocks.
   So a group of near copies costs about twice its sets, not one task per pair of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.components import components
from rollbook.llm.shared import SPACE, arrow_rows, discard, free_name, written
from rollbook.llm.shingles import mix, shingle_sets


#: Texts that are in Python at a time.
ROWS = 256

#: Least and most bits of a sketch; larger sets get one that parts them less well.
SKETCH_BITS = (64, 1 << 20)


def size_classes(largest: int, percent: int) -> list[int]:
    """Lower bounds of classes of set sizes; linked sets lie in one class or in neighbours."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(bounds[-1] * 100 // percent + 1)
    bounds += [bounds[-1] * 100 // percent + 1]
    return [*bounds, bounds[-1] * 100 // percent + 1]


@lru_cache(maxsize=4096)
def spare_parts(n: int, most: int) -> int:
    """How many parts more than ``most + 1`` hold the thin ones (fewer than two tokens, else empty) of ``n`` tokens."""
    for thin in (2, 1):
        for spare in range(most + 2):
            parts = most + 1 + spare
            share = (1 - 1 / parts) ** n + (n / parts * (1 - 1 / parts) ** (n - 1) if thin == 2 else 0)
            if parts * share + 1.5 * (parts * share * (1 - share)) ** 0.5 <= spare + 0.5:
                return spare
    return 0


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of one set; any two sets with likeness ``percent`` share one, unless they are equal.

    Small sets whose likeness must be 1 have none. With ``spare`` more parts than differences, at least
    1 + spare parts agree, so a set may leave out up to ``spare`` parts of fewer than two tokens, or else
    of none: of two sets the one that leaves out more by size decides, and an agreeing part remains.
    """
    n, out = len(tokens), []
    if not n:
        return np.empty(0, np.uint64)
    bounds = size_classes(n, percent)
    own = next(i for i in range(len(bounds)) if bounds[i + 1] > n)
    spread = mix(tokens)
    for low in (own - 1, own):
        if low < 0:
            continue
        most = (100 - percent) * (bounds[low + 1] - 1 + bounds[low + 2] - 1) // (100 + percent)
        if not most:
            continue
        spare = max(2 if bounds[low] >= 40 else int(bounds[low] >= 20), spare_parts(bounds[low + 1] - 1, most))
        parts = most + 1 + spare
        part = (spread % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        counts = np.bincount(part, minlength=parts)
        # A part is known by the sum of its tokens under another bijection, and by its number.
        sums = np.zeros(parts, dtype=np.uint64)
        full = np.flatnonzero(counts)
        sums[full] = np.add.reduceat(mix(spread[order]), (np.cumsum(counts) - counts)[full])
        signed = mix(mix(sums + counts.astype(np.uint64)) + np.uint64(low << 32) + np.arange(parts, dtype=np.uint64))
        thin = next(t for t in (2, 1, 0) if (counts < t).sum() <= spare)
        out.append(signed[counts >= thin])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def set_key(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(tokens: np.ndarray, percent: int) -> bytes:
    """Parities of the tokens, dealt to as many bits as the last range of the set has sizes (a power of two)."""
    most, bits = len(tokens) * 100 // percent, SKETCH_BITS[0]
    while bits <= most and bits < SKETCH_BITS[1]:
        bits *= 4
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(sketches: list[bytes]) -> np.ndarray:
    """The sketches as rows of words, those of more bits folded to the fewest: parities of joined bits add up."""
    words = min(map(len, sketches)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, dtype=np.uint64).reshape(-1, words), axis=0) for x in sketches])


def may_link(sketches: np.ndarray, n: np.ndarray, percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """For each set the first set that pairs which may be links lead to; with ``side`` (0 or 1) only pairs across sides count.

    A set found is compared only with sets not found yet, so sets that are much alike take a pass or two, not all pairs.
    """
    label, gone = np.arange(len(n)), np.zeros(len(n), dtype=bool)
    side = np.zeros(len(n), dtype=np.int64) if side is None else side + 1
    across = (0, 2, 1)
    by_size = np.argsort(n, kind="stable")
    left = {s: at for s in range(3) if len(at := by_size[side[by_size] == s])}
    rows, sizes = {s: sketches[at] for s, at in left.items()}, {s: n[at] for s, at in left.items()}
    found_of = dict.fromkeys(left, 0)
    for start in by_size.tolist():
        front = [] if gone[start] else [start]
        gone[start] = True
        while front:
            a = front.pop()
            s = across[side[a]]
            if s not in left:
                continue
            # Linked sizes p and q have p >= q * percent / 100; those in between lie together.
            lo = int(np.searchsorted(sizes[s], -(-int(n[a]) * percent // 100), "left"))
            hi = int(np.searchsorted(sizes[s], int(n[a]) * 100 // percent, "right"))
            differ = np.bitwise_count(rows[s][lo:hi] ^ sketches[a]).sum(axis=1, dtype=np.int64)
            # 100 * intersection >= percent * union, in terms of what differs.
            near = left[s][lo:hi][(100 + percent) * differ <= (100 - percent) * (sizes[s][lo:hi] + n[a])]
            near = near[~gone[near]]
            label[near], gone[near] = start, True
            front.extend(near.tolist())
            found_of[s] += len(near)
            if found_of[s] * 4 > len(left[s]):
                kept = ~gone[left[s]]
                left[s], sizes[s], rows[s], found_of[s] = left[s][kept], sizes[s][kept], rows[s][kept], 0
    return label


def _sign(percent: int, size: int):
    """For mapInArrow: id, mark, n_shingles, key, and signatures and a sketch where the key is new to the task."""
    schema = pa.schema([
        ("id", pa.int64()), ("mark", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.int64()), ("signatures", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in (b.slice(lo, ROWS) for b in batches for lo in range(0, b.num_rows, ROWS)):
            sets = shingle_sets(batch.column(1).to_pylist(), size)
            keys = [set_key(s) if len(s) else None for s in sets]
            signed, sketched = [], []
            for key, tokens in zip(keys, sets, strict=True):
                if key is None or key in seen:
                    signed.append(None)
                    sketched.append(None)
                    continue
                seen.add(key)
                signed.append(signatures(tokens, percent).view(np.int64))
                sketched.append(sketch(tokens, percent))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()),
                    pa.array(signed, pa.list_(pa.int64())), pa.array(sketched, pa.binary()),
                ],
                schema=schema,
            )

    return run


class PrefixTree:
    """Sets of token ranks, in one order, as a tree with merged chains; finds the linked classes.

    Node lists run in preorder: ``cut`` has the tokens of the edge, ``span`` the leaves below (sets are in
    lexicographic order), ``least`` and ``most`` the lengths of the sets below, ``after`` the next node that
    is not below.
    """

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        whole = np.sort(np.concatenate(sets))
        starts = np.flatnonzero(np.concatenate(([True], whole[1:] != whole[:-1])))
        values, counts = whole[starts], np.diff(starts, append=len(whole))
        del whole, starts
        rank = np.empty(len(values), dtype=np.int32)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(values), dtype=np.int32)
        # Set by set: nothing but the ranks themselves is as long as all sets together.
        rows = [np.sort(rank[np.searchsorted(values, s)]) for s in sets]
        self.n_tokens = len(values)
        del values, counts, rank
        self.order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">i4").tobytes())
        self.rows = [rows[i] for i in self.order]
        self.parent = list(range(len(rows)))
        self._build()

    def _build(self) -> None:
        rows, n = self.rows, len(self.rows)
        shared = [0] * (n + 1)
        for i in range(1, n):
            m = min(len(rows[i - 1]), len(rows[i]))
            differ = np.flatnonzero(rows[i - 1][:m] != rows[i][:m])
            shared[i] = int(differ[0]) if len(differ) else m
        self.cut, self.depth, self.lo, self.hi, self.after = [], [], [], [], []
        # (first leaf, last leaf + 1, depth above); a node ends where its leaves part.
        stack = [(0, n, 0)]
        pending: list = []
        while stack:
            item = stack.pop()
            if item[0] is None:
                self.after[item[1]] = len(self.cut)
                continue
            lo, hi, depth = item
            end = len(rows[lo]) if hi - lo == 1 else min(shared[lo + 1 : hi])
            node = len(self.cut)
            self.cut.append(rows[lo][depth:end])
            self.depth.append(end)
            self.lo.append(lo)
            self.hi.append(hi)
            self.after.append(0)
            stack.append((None, node, 0))
            if hi - lo > 1:
                starts = [lo] + [i for i in range(lo + 1, hi) if shared[i] == end]
                for a, b in reversed(list(zip(starts, [*starts[1:], hi], strict=True))):
                    stack.append((a, b, end))
        lengths = np.array([len(r) for r in rows])
        self.least = [int(lengths[a:b].min()) for a, b in zip(self.lo, self.hi, strict=True)]
        self.most = [int(lengths[a:b].max()) for a, b in zip(self.lo, self.hi, strict=True)]

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _one_class(self) -> list[int]:
        """Per node the class of all leaves below, or -1."""
        roots = np.array([self.find(i) for i in range(len(self.rows))])
        changes = np.concatenate(([0], np.cumsum(roots[1:] != roots[:-1]))) if len(roots) > 1 else np.zeros(1, int)
        return [int(roots[a]) if changes[b - 1] == changes[a] else -1 for a, b in zip(self.lo, self.hi, strict=True)]

    def join(self, known: list[int]) -> None:
        """Sets with equal labels are of one class before the search."""
        first: dict[int, int] = {}
        for leaf, given in enumerate(self.order):
            self.parent[self.find(leaf)] = self.find(first.setdefault(known[given], leaf))

    def classes(self) -> list[int]:
        """For each given set, the index of one set of its class (the same for all of a class)."""
        p, n_nodes = self.percent, len(self.cut)
        one, wasted = self._one_class(), 0
        inside = np.zeros(self.n_tokens, dtype=bool)
        for leaf, query in enumerate(self.rows):
            size, mine = len(query), self.find(leaf)
            inside[query] = True
            overlap_at: dict[int, int] = {0: 0}
            node, met = 0, 0
            while node < n_nodes:
                known = one[node]
                # Leaves up to this one have asked already; equal classes need no answer.
                if self.hi[node] <= leaf + 1 or (known >= 0 and self.find(known) == self.find(leaf)):
                    node = self.after[node]
                    continue
                above = self.depth[node] - len(self.cut[node])
                met = overlap_at[above] + int(np.count_nonzero(inside[self.cut[node]]))
                end = self.depth[node]
                rest = size - (int(np.searchsorted(query, self.cut[node][-1], "right")) if len(self.cut[node]) else met)
                best = met + min(rest, self.most[node] - end)
                # (100 + p) * overlap >= p * (sum of sizes) is the likeness in whole numbers.
                if (100 + p) * best < p * (size + max(self.least[node], best)):
                    node = self.after[node]
                    continue
                if self.hi[node] - self.lo[node] == 1:
                    other = self.lo[node]
                    if self.find(other) == self.find(leaf):
                        wasted += 1
                    elif (100 + p) * met >= p * (size + len(self.rows[other])):
                        a, b = self.find(leaf), self.find(other)
                        self.parent[max(a, b)] = min(a, b)
                        wasted += 1
                    node = self.after[node]
                    continue
                overlap_at[end] = met
                node += 1
            inside[query] = False
            if wasted > n_nodes // 4:
                one, wasted = self._one_class(), 0
        out = [0] * len(self.rows)
        for leaf, given in enumerate(self.order):
            out[given] = self.order[self.find(leaf)]
        return out


def _link(percent: int):
    """For mapInPandas over runs of equal (root, i, j): (node, other) pairs of one class."""

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("node")
        nodes = part["node"].to_numpy()
        if len(nodes) == 1:
            return pd.DataFrame({"u": nodes, "v": nodes})
        tree = PrefixTree([np.frombuffer(x, dtype=np.uint64) for x in part["tokens"]], percent)
        tree.join(part["known"].to_list())
        return pd.DataFrame({"u": nodes, "v": nodes[tree.classes()]})

    return _for_runs(solve)


def _for_runs(solve):
    """For mapInPandas over rows in order of (root, i, j): ``solve`` of each run of equal ones."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        last = None
        for frame in frames:
            key = frame[["root", "i", "j"]].to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(frame)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if last is not None and tuple(key[a]) != last:
                    yield solve(pd.concat(kept))
                    kept = []
                last = tuple(key[a])
                kept.append(frame.iloc[a:b])
        if kept:
            yield solve(pd.concat(kept))

    return run


def _part(percent: int):
    """For mapInPandas over runs of equal (root, i, j): each member with one of those it hangs together with by their sketches."""

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("member")
        members, blocks = part["member"].to_numpy(), part["block"].to_numpy()
        side = None if part["i"].iloc[0] == part["j"].iloc[0] else (blocks == part["j"].iloc[0]).astype(np.int64)
        label = may_link(fold(list(part["sketch"])), part["n"].to_numpy(), percent, side)
        return pd.DataFrame({"u": members, "v": members[label]})

    return _for_runs(solve)


def _tokens(size: int):
    """For mapInPandas: the set of each text, where it is the one that was asked for; copies of it once in a task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A set is sent once to each range of its group, and there once to each place it was asked for.
        goes = ["root", "node", "first", "every"]
        sent: set[tuple[int, int, int, str]] = set()
        for frame in (f.iloc[lo : lo + ROWS] for f in frames for lo in range(0, len(f), ROWS)):
            frame = frame[[a not in sent for a in frame[goes].itertuples(index=False, name=None)]].drop_duplicates(goes)
            sets = shingle_sets(list(frame["text"]), size)
            right = [set_key(s) == k for s, k in zip(sets, frame["node"], strict=True)]
            frame = frame.assign(tokens=[s.tobytes() for s in sets])[right]
            sent.update(frame[goes].itertuples(index=False, name=None))
            yield frame[["node", "root", "known", "first", "blocks", "every", "tokens"]]

    return run


def _solve(texts: DataFrame, asked: DataFrame, percent: int, size: int) -> DataFrame:
    """(u, v) pairs of one class within each task of ``asked``.

    ``asked`` has node, asked_mark, root, known, and where the set goes: to tasks (first, 0), or to (i, first)
    for every i below ``blocks`` where ``every`` is "i", or to (first, j) where it is "j".
    """
    found = texts.join(asked.hint("merge"), F.col("mark") == F.col("asked_mark"))
    sets = found.select("node", "root", "known", "first", "blocks", "every", "text").mapInPandas(
        _tokens(size), "node long, root long, known long, first int, blocks int, every string, tokens binary"
    )
    n = F.explode(F.when(F.col("every") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i = F.when(F.col("every") == "i", F.col("n")).otherwise(F.col("first"))
    j = F.when(F.col("every") == "i", F.col("first")).otherwise(F.col("n"))
    tasks = sets.withColumn("n", n).select("node", "root", "known", i.alias("i"), j.alias("j"), "tokens")
    grouped = tasks.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    with arrow_rows(texts.sparkSession, 512):
        return written(grouped.mapInPandas(_link(percent), "u long, v long"), "join-links")


def _ranges(n: Column, percent: int) -> Column:
    """The ranges of sizes that a set of ``n`` shingles is compared in: its own, and the next where that has sets it can link with."""
    bounds = [4**k for k in range(1, 16)]
    own = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= n))
    most = F.floor(n * 100 / percent)
    return F.array_distinct(F.array(own, F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= most))))


def _block(of: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(of), F.col(blocks)).cast("int")


def _parted(members: DataFrame, sketches: DataFrame, percent: int, block_bytes: int) -> DataFrame:
    """``members`` (node, root, asked_mark, n) with groups parted by their sketches (key, sketch), without sets left alone.

    Groups of more than ``block_bytes`` of sketches are dealt into blocks of half of that, and each block meets each.
    """
    sent = sketches.join(members, F.col("key") == F.col("node")).select(F.xxhash64("root", "node").alias("member"), "root", "n", "sketch")
    sent = written(sent, "join-sketches")
    # Several tasks may have made the sketch of a set; a group counts it as often, and has smaller blocks then.
    large = sent.groupBy("root").agg(F.sum(F.length("sketch")).alias("bytes")).where(F.col("bytes") > block_bytes)
    large = written(large.select("root", F.ceil(F.col("bytes") * 2 / block_bytes).cast("int").alias("blocks")), "join-blocks")
    dealt = sent.join(large, "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", _block("member", "blocks"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = met.select("member", "root", "n", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "sketch")
    grouped = tasks.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    pairs = written(grouped.mapInPandas(_part(percent), "u long, v long"), "join-parts")
    parts = pairs.toDF("member", "part") if large.isEmpty() else _merged(pairs).toDF("member", "part")
    parts = written(parts, "join-parted")
    parts = parts.join(parts.groupBy("part").agg(F.count("*").alias("sets")).where("sets > 1"), "part")
    found = members.withColumn("member", F.xxhash64("root", "node")).join(parts, "member")
    return found.select("node", F.col("part").alias("root"), "asked_mark", "n")


def linked_classes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 90, size: int = 3, block_tokens: int = 2_000_000, hubs: int = 16
) -> DataFrame:
    """One row per document: ``id``, ``n_shingles`` and ``component_id``, the least id that links lead to.

    Texts link when ``100 * intersection >= percent * union`` of their sets of ``size``-word shingles
    (bytes A-Z lowered; fewer words are one shingle). Null or blank text has the empty set, which links
    with nothing, not even with another empty set. Rows that repeat a text link. Each row counts as a
    document of its own, also when ids repeat; a row without an id takes part, but lends no id to a class.

    ``block_tokens`` bounds the shingles of a block (8 bytes each); a task holds two blocks at most. ``hubs``
    sets of a group of several blocks go to all of them.
    """
    rows = linked_rows(docs, id, text, percent, size, block_tokens, hubs)
    return rows.select(F.col("id").alias(id), "n_shingles", "component_id")


def linked_rows(
    docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 90, size: int = 3, block_tokens: int = 2_000_000, hubs: int = 16
) -> DataFrame:
    """As linked_classes, with the ``mark`` of each row (a hash of its id and text) and the ``root`` of its class, null where it is alone."""
    marked = docs.select(F.col(id).cast("long").alias("id"), F.encode(F.col(text), "UTF-8").alias("text"), F.xxhash64(F.xxhash64(id), F.xxhash64(text)).alias("mark"))
    with arrow_rows(docs.sparkSession, 512):
        signed = written(
            marked.mapInArrow(_sign(percent, size), "id long, mark long, n_shingles long, key long, signatures array<long>, sketch binary"), "join-signed"
        )
    rows = written(signed.drop("signatures"), "join-rows")
    # Rows of a signature meet once; the least node is found and joined back without a further shuffle. Both uses
    # must want the same rows, or Spark shuffles them twice: the join would ask for a key, the minimum would not.
    met = signed.where("key IS NOT NULL AND size(signatures) > 0")
    met = met.select(F.col("key").alias("node"), F.explode("signatures").alias("s")).repartition("s")
    shared = met.groupBy("s").agg(F.min("node").alias("u"), F.max("node").alias("most")).where("u <> most").select("s", "u")
    near = written(met.join(shared, "s").where("node <> u").select("u", F.col("node").alias("v")).distinct(), "join-near")
    discard(signed)  # signatures are the largest table of all
    groups = written(components(near), "join-groups")
    # Of each node in a group one text gives the set; copies of a text are counted before they meet.
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("id"), F.min("mark").alias("mark"), F.max("n_shingles").alias("n"), F.count("*").alias("rows")
    )
    ranged = groups.join(classes, F.col("node") == F.col("key")).withColumn("range", F.explode(_ranges(F.col("n"), percent)))
    met_sets = written(
        ranged.select("node", F.xxhash64("root", "range").alias("root"), F.col("mark").alias("asked_mark"), "n"), "join-met"
    )
    members = written(_parted(met_sets, rows.where("sketch IS NOT NULL").select("key", "sketch"), percent, block_tokens * 8), "join-members")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n") / block_tokens).cast("int").alias("blocks"))
    dealt = written(members.join(blocks, "root"), "join-dealt")
    found = _classes_of_groups(marked.select("mark", "text"), dealt, percent, size, block_tokens, hubs)
    whole = written(
        classes.join(found, F.col("key") == F.col("node"), "left")
        .where("root IS NOT NULL OR rows > 1")
        .select("key", F.coalesce("root", "key").alias("root"), "id"),
        "join-classes",
    )
    least = written(whole.groupBy("root").agg(F.min("id").alias("component_id")), "join-least")
    ids = written(whole.join(least, "root").select(F.col("key").alias("k"), "root", "component_id"), "join-components")
    return rows.join(ids, F.col("key") == F.col("k"), "left").select(
        "id", "mark", "n_shingles", "root", F.when(F.col("k").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def _classes_of_groups(texts: DataFrame, dealt: DataFrame, percent: int, size: int, block_tokens: int, hubs: int) -> DataFrame:
    """(node, root) of the linked classes in the groups of ``dealt`` (node, root, asked_mark, n, blocks)."""
    one_block = dealt.where("blocks = 1").select("node", "asked_mark", "root", F.col("node").alias("known"), F.lit(0).alias("first"), "blocks", F.lit("").alias("every"))
    several = dealt.where("blocks > 1")
    if several.isEmpty():
        return _merged(_solve(texts, one_block, percent, size))
    by_hash = Window.partitionBy("root").orderBy(F.xxhash64("node", F.lit(1)), "node")
    hub = written(several.withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= hubs).drop("r"), "join-hubs")
    at = ("node", "asked_mark", "root", F.col("node").alias("known"))
    first = one_block.union(several.select(*at, _block("node", "blocks"), "blocks", F.lit(""))).union(
        hub.select(*at, F.lit(0), "blocks", F.lit("i"))
    )
    links = _solve(texts, first, percent, size)
    now = written(_merged(links).withColumnRenamed("root", "known"), "join-known")
    # All but the largest class of each group meet every block once more.
    state = written(several.join(now, "node"), "join-state")
    main = state.groupBy("root", "known").agg(F.sum("n").alias("n")).groupBy("root").agg(F.max_by("known", F.struct("n", "known")).alias("main"))
    loose = state.join(main, "root").where("known <> main")
    shares = loose.groupBy("root").agg(F.ceil(F.sum("n") / block_tokens).cast("int").alias("shares"))
    asking = written(loose.join(shares, "root"), "join-asking")
    answering = state.join(shares, "root")
    second = asking.select("node", "asked_mark", "root", "known", _block("node", "shares").alias("first"), "blocks", F.lit("i").alias("every")).union(
        answering.select("node", "asked_mark", "root", "known", _block("node", "blocks"), F.col("shares"), F.lit("j"))
    )
    more = _solve(texts, written(second, "join-second"), percent, size)
    return _merged(links.union(more))


def _merged(links: DataFrame) -> DataFrame:
    """(node, root) of the classes of all nodes in ``links`` (u, v), those that link with themselves alone included."""
    alone = links.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("root"))
    return components(links).unionByName(alone).groupBy("node").agg(F.min("root").alias("root"))


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text", single: bool = False, **how) -> DataFrame:
    """One document of each class, that with the least id; others stay whole.

    Columns are as given. A row is judged by its own text: of rows with one id those stay whose text has no
    earlier like. Documents without words stay. As given, rows that repeat id and text stay together, and those
    without an id stay. With ``single`` exactly one row of each class stays: rows without an id come last, and of
    rows that repeat id and text the one whose other columns hash least.
    """
    mark, blank, nth = (free_name(docs, n) for n in ("mark", "blank", "nth"))
    marked = docs.withColumn(mark, F.xxhash64(F.xxhash64(id), F.xxhash64(text)))
    classes = linked_rows(docs, id, text, **how)
    if not single:
        # A text whose id is the least of its class stays, and so do rows that repeat it; the id with another text does not.
        first = classes.where("id = component_id").groupBy("root").agg(F.min("mark").alias("first"))
        gone = classes.join(first, "root").where("id IS NOT NULL AND mark <> first").select(F.col("mark").alias(mark)).distinct()
        return marked.join(written(gone, "join-gone").hint("merge"), mark, "left_anti").drop(mark)
    in_class = classes.where("root IS NOT NULL")
    first = in_class.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("first")).select("root", F.col("first.mark").alias("first"))
    gone = in_class.join(first, "root").where("mark <> first").select(F.col("mark").alias(mark)).distinct()
    kept = marked.join(written(gone, "join-gone").hint("merge"), mark, "left_anti")
    # Rows without words are no copies of each other: each is a group of its own.
    none = F.length(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE))) == 0
    alone = kept.withColumn(blank, F.when(none, F.monotonically_increasing_id()))
    others = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    order = Window.partitionBy(mark, blank).orderBy(F.xxhash64(*others))
    return alone.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).drop(mark, blank, nth)
