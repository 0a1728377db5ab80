"""Hard negatives by exact integer products of anchors and candidates, tile by tile.

Vectors become whole numbers. Anchors and rows are dealt into groups of bounded size; a tile is one group of
each. Inside a tile Strassen's recursion multiplies int64 matrices: odd sides get a row or column of zeros,
sums and products wrap at 64 bits, so what comes out is exact whenever the true score fits in 64 bits.

Two passes, both mergeable: the first keeps each anchor's best rows of its own label in every tile, and the best
of those over all tiles are its positives. The second keeps, for each anchor and positive, the best rows of
other labels within the score window. What tiles keep is merged by a ranked window with a limit, which Spark
applies before and after the shuffle, so no task sees more than a few entries of a tile for an anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.shared import written

#: Below this side a product is done directly.
DIRECT = 16
#: Anchors of a tile whose scores are held at a time.
STRIP = 256
#: Stands for a missing id; such rows come last among equals.
NO_ID = np.iinfo(np.int64).max


def _even(x: np.ndarray) -> np.ndarray:
    """With a row or a column of zeros where a side is odd."""
    rows, columns = x.shape
    return np.pad(x, ((0, rows % 2), (0, columns % 2))) if rows % 2 or columns % 2 else x


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices with seven half-size products per level, exact modulo 2^64."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], columns) <= DIRECT:
        return a @ b
    a, b = _even(a), _even(b)
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    m6 = strassen(a21 - a11, b11 + b12)
    m7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = m1 + m4 - m5 + m7
    out[:i, j:] = m3 + m5
    out[i:, :j] = m2 + m4
    out[i:, j:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of whole numbers as rows; shorter ones end in zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _longs(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).fill_null(NO_ID).to_numpy()


def _side(table: pa.Table, width: int, *more: str):
    """Rows of one side of a tile by ascending id: numbers, ids, labels, vectors, and further columns."""
    order = np.lexsort((_longs(table, "row"), _longs(table, "vec")))
    table = table.take(pa.array(order))
    return (_longs(table, "row"), _longs(table, "vec"), _longs(table, "label"), _matrix(table.column("q"), width), *(table.column(c).to_pylist() for c in more))


def _out(schema: pa.Schema, parts: list[tuple]) -> pa.Table:
    if not parts:
        return schema.empty_table()
    columns = [np.concatenate([np.broadcast_to(p[c], np.shape(p[-1])) for p in parts]) for c in range(len(schema))]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_NEAR = pa.schema([("anchor", pa.int64()), ("vec", pa.int64()), ("score", pa.int64())])
_FAR = pa.schema([("anchor", pa.int64()), ("nth", pa.int32()), ("vec", pa.int64()), ("score", pa.int64())])


def _positives(width: int, best: int):
    """Of a tile: each anchor's best other rows of its label. Only equal labels are multiplied."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        a_row, _, a_label, a, = _side(anchors, width)
        row, vec, label, b = _side(rows, width)
        parts = []
        for one in np.unique(a_label):
            mine, theirs = np.flatnonzero(a_label == one), np.flatnonzero(label == one)
            if not len(theirs):
                continue
            across = np.ascontiguousarray(b[theirs].T)
            for strip in np.array_split(mine, -(-len(mine) // STRIP)):
                scores = strassen(a[strip], across)
                for i, s in zip(strip, scores, strict=True):
                    other = np.flatnonzero(row[theirs] != a_row[i])
                    # The best few by score; of equals the first, which has the least id.
                    top = other[np.argsort(-s[other], kind="stable")[:best]]
                    parts.append((a_row[i], vec[theirs[top]], s[top]))
        return _out(_NEAR, parts)

    return run


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole n with low * positive <= 100 * n <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def _negatives(width: int, best: int, low: int, high: int):
    """Of a tile: for each anchor and positive the best rows of other labels in the window."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        a_row, _, a_label, a, positive = _side(anchors, width, "positives")
        _, vec, label, b = _side(rows, width)
        across, parts = np.ascontiguousarray(b.T), []
        for lo in range(0, len(a_row), STRIP):
            scores = strassen(a[lo : lo + STRIP], across)
            for i, s in enumerate(scores, lo):
                windows = [window_of(p, low, high) for p in positive[i]]
                least, most = min(w[0] for w in windows), max(w[1] for w in windows)
                held = np.flatnonzero((s >= least) & (s <= most) & (label != a_label[i]))
                held = held[np.argsort(-s[held], kind="stable")]
                falling = -s[held]
                for nth, (least, most) in enumerate(windows):
                    first, end = np.searchsorted(falling, -most, "left"), np.searchsorted(falling, -least, "right")
                    top = held[first : min(end, first + best)]
                    if len(top):
                        parts.append((a_row[i], nth, vec[top], s[top]))
        return _out(_FAR, parts)

    return run


def whole_numbers(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of each component as a double; null where the vector or a component is missing or not finite."""
    x = lambda v: v.cast("double")
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(x(v)) & (F.abs(x(v)) < F.lit(float("inf"))))
    return F.when(finite, F.transform(embedding, lambda v: F.floor(F.lit(float(scale)) * x(v))))


def _in_range(q: Column, embedding: Column, scale: int) -> Column:
    """``q``, or an error where scores with this vector could leave 64 bits: by the sum of squares of the scaled components."""
    squares = F.aggregate(embedding, F.lit(0.0), lambda s, v: s + F.pow(F.floor(F.lit(float(scale)) * v.cast("double")).cast("double"), F.lit(2.0)))
    return F.when(squares >= float(2**62), F.raise_error("a vector is too long for 64-bit scores").cast("array<long>")).otherwise(q)


def mine(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    anchor: Column | None = None,
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    anchors_a_tile: int = 4096,
    rows_a_tile: int = 4096,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows where ``anchor`` holds (default: all). An anchor's positives are its ``n_positives`` best
    other rows of the same label, its negatives for a positive the ``n_negatives`` best rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``. Higher scores come first, then smaller ids.

    Rows without a label or a vector, or with a component that is null or not finite, take no part. Rows that repeat
    an id are rows of their own (another row with the anchor's id and label may be its positive); rows without an id
    take part and come last among equals. Vectors of unequal length are filled with zeros; an empty one scores 0
    everywhere. A vector whose scaled square sum reaches 2^62 is an error, because its scores might not fit in 64 bits.
    An empty table gives no rows. Other columns play no part, whatever their names.

    Both sides of a tile are bounded, so memory does not grow with the table, and a label that most rows have is in
    many tiles. The scores of a stated set of anchors against all rows are computed once for rows of the same label
    and once for the others.
    """
    label = F.col(label) if isinstance(label, str) else label
    anchor = F.lit(True) if anchor is None else anchor
    numbers = whole_numbers(F.col(vector), scale)
    used = vectors.select(
        F.col(id).cast("long").alias("vec"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("asks"),
        F.when(numbers.isNotNull(), _in_range(numbers, F.col(vector), scale)).alias("q"),
    ).where("label IS NOT NULL AND q IS NOT NULL")
    # Row numbers are final once they are written.
    rows = written(used.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    size = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("m"), F.max(F.size("q")).alias("width")).first()
    if not size.m:
        return _empty(vectors)
    width = max(1, size.width)
    a_groups, r_groups = -(-size.m // anchors_a_tile), -(-size.n // rows_a_tile)
    group = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tiles = rows.select("row", "vec", "label", "q", group(r_groups).alias("r"), every(a_groups).alias("a")).groupBy("a", "r")

    def passed(anchors: DataFrame, function, schema: str) -> DataFrame:
        dealt = anchors.withColumn("a", group(a_groups)).withColumn("r", every(r_groups))
        return dealt.toDF(*dealt.columns).groupBy("a", "r").cogroup(tiles).applyInArrow(function, schema)

    first = passed(rows.where("asks").select("row", "vec", "label", "q"), _positives(width, n_positives), "anchor long, vec long, score long")
    better = [F.desc("score"), F.asc("vec")]
    nth = Window.partitionBy("anchor").orderBy(*better)
    positives = first.withColumn("nth", F.row_number().over(nth) - 1).where(F.col("nth") < n_positives)
    listed = F.array_sort(F.collect_list(F.struct("nth", "vec", "score")))
    positives = written(positives.groupBy("anchor").agg(listed.alias("listed")), "negatives-positives")
    asked = rows.where("asks").join(positives, F.col("row") == F.col("anchor")).select("row", "vec", "label", "q", F.col("listed.score").alias("positives"))
    second = passed(asked, _negatives(width, n_negatives, low, high), "anchor long, nth int, vec long, score long")
    rank = Window.partitionBy("anchor", "nth").orderBy(*better)
    second = second.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= n_negatives)
    names = rows.where("asks").select(F.col("row").alias("anchor"), F.col("vec").alias("anchor_id"))
    missing = lambda c: F.when(c != F.lit(int(NO_ID)), c)
    found = second.join(positives, "anchor").join(names, "anchor").withColumn("positive", F.get("listed", F.col("nth")))
    return found.select(
        "anchor_id", missing(F.col("positive.vec")).alias("positive_id"), "rank", missing(F.col("vec")).alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def _empty(vectors: DataFrame) -> DataFrame:
    return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
