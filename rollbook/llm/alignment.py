"""Alignment of two tokenizers, with corpus-wide counts of linked token pairs by external spill counting.

Tasks encode texts with both tokenizers. Byte offsets where tokens of both sides end cut them into groups; every
A token of a group is linked with every B token of it. The distinct pairs of each document are records.

1. A run is what some thousand documents give: their records ordered by A id, then B id, dealt into radix parts
   by A id and kept as zstd frames. A part has the distinct pairs of the run and in how many of its documents
   each occurs, so a pair that all documents share is one entry of a run.
2. The parts of one radix are merged by a heap over the runs' frames, which adds up the documents of each pair.
   Several rounds are made where there are many runs: a task merges ``fan`` parts at most. The order is by A id
   first, so an A id's pairs come together and its largest count is known once they have passed.
3. Counts go back in the order of the parts that asked, as one frame per part, down the same rounds. In its run,
   each record adds its pair's count to its document.

No task sees more than a run, or ``fan`` parts and the distinct pairs in them; nothing goes through the driver but
the number of runs.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.bin_slack import Encoder
from rollbook.llm.shared import arrow_rows, written

#: Texts that are encoded at a time, and the code points after which a batch ends all the same.
ROWS, CHARS = 128, 1 << 20
#: Groups with more links than this are counted by their distinct ids, not link by link.
LARGE = 1 << 12
#: Pairs of a frame; the heap holds one frame of each run.
FRAME = 1 << 14
#: A pair is one number: A id * SHIFT + B id. Ids are below SHIFT, and texts of a batch fewer than 2^23.
SHIFT = np.int64(1 << 20)


class Side:
    """A tokenizer as a function from a list of texts to lists of ids, with the bytes of each id."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], token_bytes: list[bytes]):
        self.encode, self.bytes = encode, token_bytes
        self.lengths = np.array([len(b) for b in token_bytes], np.int64)
        self.starts, self.all_bytes = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(token_bytes), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of some ids, one after the other."""
        lengths = self.lengths[ids]
        return self.all_bytes[np.arange(int(lengths.sum())) + np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)]


def flat_ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and how many each list has."""
    counts = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum())), counts


def spelled_alike(texts: list[bytes], a: list[list[int]], b: list[list[int]], sides: tuple[Side, Side]) -> list[bool]:
    """Whether both sides spell a text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    (a_ids, n_a), (b_ids, n_b) = flat_ids(a), flat_ids(b)
    alike = np.ones(len(texts), bool)
    for side, ids, n in ((sides[0], a_ids, n_a), (sides[1], b_ids, n_b)):
        ends = np.concatenate(([0], np.cumsum(side.lengths[ids])))[np.concatenate(([0], np.cumsum(n)))]
        alike &= np.diff(ends) == sizes
    wanted = np.flatnonzero(alike)
    whole = np.frombuffer(b"".join(texts[i] for i in wanted), np.uint8)
    bounds = np.concatenate(([0], np.cumsum(sizes[wanted])))
    for side, ids, n in ((sides[0], a_ids, n_a), (sides[1], b_ids, n_b)):
        wrong = np.concatenate(([0], np.cumsum(side.spell(ids[np.repeat(alike, n)]) != whole)))
        alike[wanted] &= wrong[bounds[1:]] == wrong[bounds[:-1]]
        if not alike[wanted].all():  # the other side is then compared text by text
            return [bool(ok) and b"".join(map(sides[0].bytes.__getitem__, x)) == t == b"".join(map(sides[1].bytes.__getitem__, y)) for ok, t, x, y in zip(alike, texts, a, b, strict=True)]
    return alike.tolist()


def ends_in(ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which of rising numbers are among others that rise."""
    at = np.searchsorted(other, ends)
    return other[np.minimum(at, len(other) - 1)] == ends if len(other) else np.zeros(len(ends), bool)


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it prints, else from U+0100 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + n): b for n, b in enumerate(others)}


class PlainEncoder(Encoder):
    """Ids of a byte-level BPE where strings of special tokens are ordinary text."""

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None and text.isascii():
            return self.fast.encode_ordinary(text)
        if self.fast is not None:
            try:
                text.encode("latin-1")
                return self.fast.encode_ordinary(text)
            except UnicodeEncodeError:
                pass
        self.standard.encode_special_tokens = True
        return self.standard.encode(text, add_special_tokens=False).ids


def public_sides() -> tuple[Side, Side]:
    """Side A reads a blank and the text by byte-level BPE, side B the text by pieces, which adds the blank."""
    import public_tokenizers as public
    import sentencepiece

    plain = PlainEncoder(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    alphabet = byte_level_alphabet()
    vocabulary = plain.standard.get_vocab(with_added_tokens=True)
    a_bytes = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    pieces = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    b_bytes = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        b_bytes.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return (
        Side(lambda texts: [plain(" " + t) for t in texts], a_bytes),
        Side(lambda texts: pieces.encode(texts, num_threads=1), b_bytes),
    )


_DIGITS: np.ndarray | None = None


def _digits(most: int) -> np.ndarray:
    """Decimal digits of 0 to ``most`` as a row of bytes each, with zeros in front and one free byte at the end."""
    global _DIGITS
    if _DIGITS is None or len(_DIGITS) <= most:
        width = len(str(most)) + 1
        text = b"".join(str(i).encode().rjust(width - 1, b"\0") + b"\0" for i in range(most + 1))
        _DIGITS = np.frombuffer(text, np.uint8).reshape(-1, width)
    return _DIGITS


class Aligned:
    """Groups and records of some texts that both sides spell alike, laid end to end."""

    def __init__(self, a: list[list[int]], b: list[list[int]], sides: tuple[Side, Side]):
        (self.a, self.n_a), (self.b, self.n_b) = flat_ids(a), flat_ids(b)
        a_end, b_end = np.cumsum(sides[0].lengths[self.a]), np.cumsum(sides[1].lengths[self.b])
        # Every token has bytes, so ends rise; a token that ends with one of the other side closes a group.
        a_closes, b_closes = ends_in(a_end, b_end), ends_in(b_end, a_end)
        common = a_end[a_closes]
        self.a_group, self.b_group = (np.cumsum(c) - c for c in (a_closes, b_closes))
        n = len(common)
        self.in_a, self.in_b = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        doc_end = a_end[np.cumsum(self.n_a) - 1] if len(self.n_a) else np.empty(0, np.int64)
        self.group_doc = np.searchsorted(doc_end, common)
        last = np.searchsorted(common, doc_end)
        self.closes = np.zeros(n, bool)
        self.closes[last] = True
        docs = len(self.n_a)
        self.n_groups = np.bincount(self.group_doc, minlength=docs)
        links = self.in_a * self.in_b
        total = np.concatenate(([0], np.cumsum(links)))
        self.n_links = total[last + 1] - total[np.concatenate(([-1], last[:-1])) + 1] if docs else np.empty(0, np.int64)
        self.links = links

    def spelled(self) -> list[bytes]:
        """Per text ``a1,a2|b1;a3|b2,b3``."""
        before_b = np.concatenate(([0], np.cumsum(self.in_b)))
        before_a = np.concatenate(([0], np.cumsum(self.in_a)))
        place_a = np.arange(len(self.a)) + before_b[self.a_group]
        place_b = np.arange(len(self.b)) + before_a[self.b_group + 1]
        ids, ends = np.empty(len(self.a) + len(self.b), np.int64), np.full(len(self.a) + len(self.b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        ends[place_a[before_a[1:] - 1]] = ord("|")
        ends[place_b[before_b[1:] - 1]] = np.where(self.closes, 0, ord(";"))
        rows = _digits(int(max(ids.max(initial=0), 9)))[ids]
        rows[:, -1] = ends
        shown = rows != 0
        cuts = np.cumsum(shown.sum(axis=1))[np.cumsum(self.n_a + self.n_b) - 1]
        flat = rows[shown].tobytes()
        return [flat[x:y] for x, y in zip([0, *cuts[:-1]], cuts, strict=True)]

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) of every distinct pair of each text, by text and pair."""
        small = (self.links <= LARGE)[self.a_group]
        group = self.a_group[small]
        times = self.in_b[group]
        first = (np.cumsum(self.in_b) - self.in_b)[group]
        begin = np.cumsum(times) - times
        other = np.arange(int(times.sum())) - np.repeat(begin - first, times)
        pair = np.repeat(self.a[small], times) * SHIFT + self.b[other]
        doc, n = np.repeat(self.group_doc[group], times), np.ones(len(pair), np.int64)
        parts = [(doc, pair, n)]
        for g in np.flatnonzero(self.links > LARGE):
            (xs, nx), (ys, ny) = (np.unique(t[slice(*np.searchsorted(gs, (g, g + 1)))], return_counts=True) for t, gs in ((self.a, self.a_group), (self.b, self.b_group)))
            parts.append((np.full(len(xs) * len(ys), self.group_doc[g]), (xs[:, None] * SHIFT + ys).ravel(), (nx[:, None] * ny).ravel()))
        doc, pair, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        key = doc * (SHIFT * SHIFT) + pair
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        return key[new] // (SHIFT * SHIFT), key[new] % (SHIFT * SHIFT), np.add.reduceat(n[order], new) if len(new) else n


def pack_numbers(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers as one zstd frame, rising ones by their steps, in the fewest bytes that all need."""
    values = np.diff(values, prepend=0) if rising else values
    width = next(w for w in (1, 2, 4, 8) if int(values.max(initial=0)) < 1 << (8 * w - (w == 8)))
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes())


def unpack_numbers(frame: bytes, rising: bool = False) -> np.ndarray:
    width = frame[0]
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame[1:]), np.uint8).reshape(width, -1)
    values = np.ascontiguousarray(flat.T).view(f"<u{width}").ravel().astype(np.int64)
    return np.cumsum(values) if rising else values


_RUN_FIELDS = [
    ("run", pa.int64()), ("radix", pa.int32()), ("pairs", pa.list_(pa.binary())), ("held", pa.list_(pa.binary())), ("docs", pa.binary()), ("links", pa.binary()),
    ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("nth", pa.int32()),
]
_RUN = pa.schema(_RUN_FIELDS)
_RUN_DDL = "run long, radix int, pairs array<binary>, held array<binary>, docs binary, links binary, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, nth int"


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = max(len(c) for c in columns.values())
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def frames(pairs: np.ndarray, held: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Rising pairs and their counts in frames of bounded size."""
    cuts = range(0, len(pairs), FRAME)
    return [pack_numbers(pairs[c : c + FRAME], True) for c in cuts], [pack_numbers(held[c : c + FRAME]) for c in cuts]


class Run:
    """Records of the documents of one run, until they are written."""

    def __init__(self, number: int, parts: int):
        self.number, self.parts, self.n = number, parts, 0
        self.records: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, doc: np.ndarray, pair: np.ndarray, links: np.ndarray) -> None:
        self.records.append((doc, pair, links))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row for each radix part, by A id: its pairs, in how many documents they are, and the records behind them."""
        if not self.records:
            return
        doc, pair, links = (np.concatenate(x) for x in zip(*self.records, strict=True))
        radix = (pair // SHIFT) % self.parts
        order = np.argsort(radix * (SHIFT * SHIFT) + pair, kind="stable")  # documents rise already
        doc, pair, links, radix = doc[order], pair[order], links[order], radix[order]
        cuts = np.searchsorted(radix, np.arange(self.parts + 1))
        for r in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[r], cuts[r + 1]
            distinct, held = np.unique(pair[a:b], return_counts=True)
            keys, counts = frames(distinct, held)
            yield _rows(_RUN, run=[self.number], radix=[int(r)], pairs=[keys], held=[counts], docs=[pack_numbers(doc[a:b])], links=[pack_numbers(links[a:b])])


def _encode(sides, parts: int, run_docs: int, run_chars: int):
    """For mapInArrow over (id, text): a row for each document, and one for each radix part of a run."""

    def batch_rows(run: Run, keys: list, texts: list, two: tuple[Side, Side]) -> pa.RecordBatch:
        wanted = [i for i, t in enumerate(texts) if t]
        a, b = (s.encode([texts[i] for i in wanted]) for s in two)
        spelled = spelled_alike([(" " + texts[i]).encode() for i in wanted], a, b, two)
        wanted, a, b = ([v for v, ok in zip(x, spelled, strict=True) if ok] for x in (wanted, a, b))
        columns = {c: np.zeros(len(texts), np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        digests = [""] * len(texts)
        if wanted:
            aligned, at = Aligned(a, b, two), np.array(wanted)
            for c, values in columns.items():
                values[at] = getattr(aligned, c)
            for i, line in zip(wanted, aligned.spelled(), strict=True):
                digests[i] = hashlib.sha256(line).hexdigest()
            doc, pair, links = aligned.records()
            run.add(at[doc] + run.n, pair, links)
        nth = np.arange(run.n, run.n + len(texts))
        run.n += len(texts)
        return _rows(_RUN, run=np.full(len(texts), run.number), id=keys, groups_sha256=digests, nth=nth, **columns)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(key)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if len(keys) >= ROWS or size >= CHARS:
                    yield keys, texts
                    keys, texts, size = [], [], 0
        if keys:
            yield keys, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, number, chars = sides(), TaskContext.get().partitionId() << 32, 0
        now = Run(number, parts)
        for keys, texts in slices(batches):
            yield batch_rows(now, keys, texts, two)
            chars += sum(len(t or "") for t in texts)
            if now.n >= run_docs or chars >= run_chars:
                yield from now.batches()
                number, chars = number + 1, 0
                now = Run(number, parts)
        yield from now.batches()

    return run


def merged(parts: list[tuple[list[bytes], list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and summed counts of several parts: a heap over the last pair of the frame that each part holds.

    The part whose frame ends first is next; all pairs up to that end, of whatever part, are then complete.
    """
    heap: list[tuple[int, int]] = []
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    at = [0] * len(parts)

    def fetch(i: int) -> None:
        pairs, counts = parts[i]
        if at[i] < len(pairs):
            held[i] = unpack_numbers(pairs[at[i]], True), unpack_numbers(counts[at[i]])
            heapq.heappush(heap, (int(held[i][0][-1]), i))
            at[i] += 1
        else:
            held.pop(i, None)

    for i in range(len(parts)):
        fetch(i)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    while heap:
        end = heap[0][0]
        taken = []
        for i, (pairs, counts) in list(held.items()):
            cut = int(np.searchsorted(pairs, end, "right"))
            if cut:
                taken.append((pairs[:cut], counts[:cut]))
                held[i] = pairs[cut:], counts[cut:]
        pairs, counts = (np.concatenate(x) for x in zip(*taken, strict=True))
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
        out.append((pairs[first], np.add.reduceat(counts, first)))
        while heap and heap[0][0] == end:
            fetch(heapq.heappop(heap)[1])
    pairs, counts = (np.concatenate(x) for x in zip(*out, strict=True))
    return pairs, counts


def best_of_first(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair has the largest count of its A id; pairs rise, so those of an A id lie together."""
    a = pairs // SHIFT
    first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    return counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(a))))


_PART = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("pairs", pa.list_(pa.binary())), ("held", pa.list_(pa.binary()))])
_PART_DDL = "run long, radix int, pairs array<binary>, held array<binary>"
_ANSWER = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("counts", pa.binary()), ("best", pa.binary())])
_ANSWER_DDL = "run long, radix int, counts binary, best binary"


def _parts_of(table: pa.Table) -> list[tuple[list[bytes], list[bytes]]]:
    return list(zip(table.column("pairs").to_pylist(), table.column("held").to_pylist(), strict=True))


def _answers(table: pa.Table, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> Iterator[tuple]:
    """Counts and marks of each part's pairs, in its own order."""
    for run, radix, asked in zip(table.column("run").to_pylist(), table.column("radix").to_pylist(), table.column("pairs").to_pylist(), strict=True):
        at = np.searchsorted(pairs, np.concatenate([unpack_numbers(x, True) for x in asked]))
        yield run, radix, pack_numbers(counts[at]), pack_numbers(best[at].astype(np.int64))


def _table(schema: pa.Schema, rows) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _settle(table: pa.Table) -> pa.Table:
    pairs, counts = merged(_parts_of(table))
    return _table(_ANSWER, _answers(table, pairs, counts, best_of_first(pairs, counts)))


def _merge(table: pa.Table) -> pa.Table:
    keys, counts = frames(*merged(_parts_of(table)))
    return _table(_PART, [(table.column("parent")[0].as_py(), table.column("radix")[0].as_py(), keys, counts)])


def _hand_down(children: pa.Table, parent: pa.Table) -> pa.Table:
    pairs, _ = merged(_parts_of(children))
    counts, best = (unpack_numbers(parent.column(c)[0].as_py()) for c in ("counts", "best"))
    return _table(_ANSWER, _answers(children, pairs, counts, best.astype(bool)))


def settled(parts: DataFrame, runs: int, fan: int) -> DataFrame:
    """(run, radix, counts, best): for every part of ``parts`` the corpus-wide counts of its pairs."""
    if runs <= fan:
        return parts.groupBy("radix").applyInArrow(_settle, _ANSWER_DDL)
    parents = -(-runs // max(2, fan // 2))  # hashing fills some of them above the mean
    dealt = parts.withColumn("parent", F.pmod(F.xxhash64("run"), F.lit(parents)))
    above = written(dealt.groupBy("radix", "parent").applyInArrow(_merge, _PART_DDL), "align-merged")
    answers = settled(above, parents, fan).withColumnRenamed("run", "parent")
    return dealt.groupBy("radix", "parent").cogroup(answers.groupBy("radix", "parent")).applyInArrow(_hand_down, _ANSWER_DDL)


_OUT = pa.schema([(n, pa.int64()) for n in ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())])
_OUT_DDL = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _contribute(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a run, with what the counts of their records add up to."""
    docs = rows.filter(pa.compute.is_valid(rows.column("nth"))).sort_by("nth")
    n_best, count_sum = (np.zeros(docs.num_rows, np.int64) for _ in range(2))
    told = {r: (c, b) for r, c, b in zip(*(answers.column(c).to_pylist() for c in ("radix", "counts", "best")), strict=True)}
    parts = rows.filter(pa.compute.is_valid(rows.column("radix")))
    for radix, held, docs_of, links in zip(*(parts.column(c).to_pylist() for c in ("radix", "held", "docs", "links")), strict=True):
        counts, best = map(unpack_numbers, told[radix])
        times = np.concatenate([unpack_numbers(x) for x in held])
        doc, n = unpack_numbers(docs_of), unpack_numbers(links)
        np.add.at(count_sum, doc, np.repeat(counts, times) * n)
        np.add.at(n_best, doc, np.repeat(best, times) * n)
    columns = {"n_best": n_best, "count_sum": count_sum}
    return pa.Table.from_arrays([pa.array(columns[f.name]) if f.name in columns else docs.column(f.name).combine_chunks() for f in _OUT], schema=_OUT)


def align(
    docs: DataFrame, id: str = "doc_id", text: str = "text", sides=public_sides, parts: int = 32, run_docs: int = 2048, run_chars: int = 1 << 23, fan: int = 256
) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``sides`` makes, in a task, both tokenizers. A pair's count is the number of rows whose text links it; ``n_best``
    are the links whose count is the largest of their A id in the corpus, ``count_sum`` adds counts over links.
    Rows that repeat an id or a text are documents of their own; a row without an id counts too. Null and empty
    texts, and those that a side spells otherwise than a blank and the text, have zeros and an empty digest. A very
    long text is a run of its own. An empty table gives no rows; other columns play no part.

    ``parts`` is the number of radix parts, ``run_docs`` and ``run_chars`` end a run, ``fan`` bounds what a merge reads.
    """
    with arrow_rows(docs.sparkSession, 512):
        read = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
        runs = written(read.mapInArrow(_encode(sides, parts, run_docs, run_chars), _RUN_DDL), "align-runs")
    pieces = runs.where("radix IS NOT NULL").select("run", "radix", "pairs", "held")
    answers = settled(pieces, pieces.select("run").distinct().count(), fan)
    whole = runs.drop("pairs")
    return whole.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_contribute, _OUT_DDL).withColumnRenamed("id", id)
