"""Hard negatives, tokenizer alignment and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollbook.llm import alignment, hard_negatives, repeats
from rollbook.llm.hard_negatives import mine, strassen, window_of

# Hard negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 33, 65), (40, 64, 100), (64, 64, 64), (3, 200, 5), (129, 31, 47)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(3)
    m, k, n = shape
    a, b = rng.integers(-(2**27), 2**27, (m, k)), rng.integers(-(2**27), 2**27, (k, n))
    assert (strassen(a, b) == a @ b).all()


def test_strassen_wraps_where_sums_do_not_fit_but_the_product_does():
    a = np.full((34, 34), 2**62, np.int64)
    b = np.zeros((34, 34), np.int64)
    b[0, :] = 1
    assert (strassen(a, b) == a @ b).all()


@given(st.integers(-(10**20), 10**20))
def test_window_is_exact(p):
    low, high = window_of(p, 50, 95)
    assert 50 * p <= 100 * low and 100 * (low - 1) < 50 * p and 100 * high <= 95 * p < 100 * (high + 1)


def brute_negatives(rows, is_anchor):
    taken = []
    for key, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        taken.append((key, [int(np.floor(256 * float(x))) for x in vector], label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, (key, q, label) in enumerate(taken):
        if not is_anchor(key):
            continue
        scored = [(score(q, v), k, lab) for j, (k, v, lab) in enumerate(taken) if j != i]
        for s, p, _ in sorted((x for x in scored if x[2] == label), key=order)[:5]:
            fit = sorted((x for x in scored if x[2] != label and 50 * s <= 100 * x[0] <= 95 * s), key=order)[:3]
            out += [(key, p, rank, n, s, t) for rank, (t, n, _) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def mined(frame, **how):
    return sorted(map(tuple, mine(frame, anchor=F.col("vec_id") % 5 == 0, **how).collect()), key=repr)


@pytest.mark.parametrize("tile", [4096, 7])
def test_negatives_of_many_rows(spark, tile):
    rng = random.Random(5)
    # Few different values: many equal scores. One label has a third of the rows.
    rows = [(i, [rng.choice([-0.5, 0.1, 0.3, 0.8]) for _ in range(9)], rng.choice([0, 0, 0, 1, 2, 3])) for i in range(150)]
    want = brute_negatives(rows, lambda k: k % 5 == 0)
    assert len(want) > 100
    assert mined(vectors(spark, rows), anchors_a_tile=tile, rows_a_tile=tile) == want


def test_negatives_of_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (5, [1.0, 0.9], 1), (6, [0.9, 0.5], 2), (6, [0.9, 0.5], 2), (None, [0.9, 0.5], 2), (7, [0.8, 0.5, 9.0], 3),
        (8, [1.0, 1.0], None), (9, None, 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (12, [None, 1.0], 1), (13, [], 1), (15, [0.7], 2), (20, [-1.0, -1.0], 4), (None, [1.0, 1.0], 1),
    ]
    want = brute_negatives(rows, lambda k: k is not None and k % 5 == 0)
    assert want and mined(vectors(spark, rows)) == want
    more = vectors(spark, rows).select("*", F.lit(1).alias("row"), F.lit("x").alias("score"), F.lit(2).alias("anchor"), F.lit(3).alias("q"))
    assert mined(more) == want
    empty = mine(vectors(spark, []), anchor=F.col("vec_id") % 5 == 0)
    assert empty.count() == 0 and empty.columns == mine(vectors(spark, rows)).columns


def test_vectors_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="too long for 64-bit"):
        mine(vectors(spark, [(0, [1e30], 1), (1, [1.0], 1)])).collect()


# Alignment


def _toy():
    """A takes up to three letters, B up to four and bytes beyond ASCII one by one; B spells tabs as blanks."""

    def sides():  # a local function, so that it is sent to workers whole
        def words(n):
            return [bytes([b]) for b in range(256)] + [bytes(w) for w in itertools.product(b"ab ", repeat=n)]

        def encoder(table, n, spell):
            at = {w: i for i, w in enumerate(table)}

            def ids(text):
                data = (" " + spell(text)).encode()
                return [i for k in range(0, len(data), n) for w in [data[k : k + n]] for i in ([at[w]] if w in at else [at[bytes([x])] for x in w])]

            return lambda texts: [ids(t) for t in texts]

        a, b = words(3), words(4)
        return alignment.Side(encoder(a, 3, str), a), alignment.Side(encoder(b, 4, lambda t: t.replace("\t", " ")), b)

    return sides


toy_sides = _toy()


def brute_alignment(rows, sides):
    a_side, b_side = sides
    docs = []
    for key, text in rows:
        groups = []
        if text:
            (a,), (b,) = a_side.encode([text]), b_side.encode([text])
            spell = lambda x, s: b"".join(s.bytes[i] for i in x)
            if spell(a, a_side) == (" " + text).encode() == spell(b, b_side):
                i = j = x = y = 0
                now = ([], [])
                while i < len(a) or j < len(b):
                    if x <= y:
                        x += len(a_side.bytes[a[i]])
                        now[0].append(a[i])
                        i += 1
                    else:
                        y += len(b_side.bytes[b[j]])
                        now[1].append(b[j])
                        j += 1
                    if x == y:
                        groups.append(now)
                        now = ([], [])
        docs.append((key, groups))
    linked = [Counter((p, q) for g in groups for p in g[0] for q in g[1]) for _, groups in docs]
    held = Counter(pair for c in linked for pair in c)
    best = defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    out = []
    for (key, groups), c in zip(docs, linked, strict=True):
        line = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((
            key, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(c.values()),
            sum(n for (p, q), n in c.items() if held[p, q] == best[p]), sum(n * held[x] for x, n in c.items()), hashlib.sha256(line.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def texts_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def hard_texts(seed=2, n=60):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("ab  aab") for _ in range(rng.choice([1, 3, 11, 12, 40, 300])))) for i in range(n)]
    rows += [(1, None), (None, ""), (None, "ab ab"), (None, "ab ab"), (2, "a\tb"), (3, "käse 漢字 ab"), (4, "a" * 5000), (5, "<|endoftext|> <s>")]
    return rows


@pytest.mark.parametrize("how", [{}, {"run_docs": 3, "parts": 3, "fan": 2}, {"run_chars": 10, "parts": 1, "fan": 4}])
def test_alignment_of_toy_sides(spark, how):
    rows = hard_texts()
    got = alignment.align(texts_frame(spark, rows), sides=toy_sides, **how)
    assert got.columns[0] == "doc_id"
    assert sorted(map(tuple, got.collect()), key=repr) == brute_alignment(rows, toy_sides())


def test_alignment_of_the_public_sides(spark):
    rng, words = random.Random(4), "the of and naïve  straße 漢字 ▁ tokenization\n\n\t x+=1; <s> </s> <|endoftext|> 🙂 don't 1234567 ﬁ é é  ".split(" ")
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 60])))) for i in range(80)] + hard_texts(n=5)
    got = sorted(map(tuple, alignment.align(texts_frame(spark, rows), run_docs=16, fan=3).collect()), key=repr)
    assert got == brute_alignment(rows, alignment.public_sides())
    assert sum(r[1] > 0 for r in got) > 40


def test_plain_ids_are_those_of_the_standard_tokenizer():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    standard = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    standard.encode_special_tokens = True
    side = alignment.public_sides()[0]
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(chr(rng.choice([*range(256), 32, 32, 10, 101])) for _ in range(40)) + "<|endoftext|>"
        assert side.encode([text]) == [standard.encode(" " + text, add_special_tokens=False).ids]
    for i, b in enumerate(side.bytes[:50256]):
        if b.decode("utf-8", "ignore").encode() == b:
            assert standard.decode([i]) == b.decode()


def test_large_groups_are_counted_by_distinct_ids(monkeypatch, spark):
    rows = hard_texts(n=20)
    a_side, b_side = toy_sides()
    wanted = [t for _, t in rows if t and "\t" not in t]
    aligned = lambda: alignment.Aligned(a_side.encode(wanted), b_side.encode(wanted), (a_side, b_side)).records()
    plain = aligned()
    monkeypatch.setattr(alignment, "LARGE", 0)
    assert all((x == y).all() for x, y in zip(plain, aligned(), strict=True))


@given(st.lists(st.integers(0, 2**62), max_size=50), st.booleans())
def test_packed_numbers_come_back(values, rising):
    values = np.array(sorted(values) if rising else values, np.int64)
    assert (alignment.unpack_numbers(alignment.pack_numbers(values, rising), rising) == values).all()


def test_alignment_of_nothing_and_of_other_columns(spark):
    assert alignment.align(texts_frame(spark, []), sides=toy_sides).count() == 0
    frame = texts_frame(spark, [(1, "ab")]).select("*", F.lit(1).alias("run"), F.lit(2).alias("id"), F.lit("x").alias("radix"))
    assert sorted(map(tuple, alignment.align(frame, sides=toy_sides).collect())) == brute_alignment([(1, "ab")], toy_sides())


# Repeated passages


def brute_repeats(rows, least):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for (key, _), t in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - least + 1):
            if seen[t[i : i + least]] > 1:
                gone[i : i + least] = [True] * least
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed, n=60, letters="abcdefghij \n"):
    """Texts of few letters that share passages, with changes, cuts at both ends, and copies."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [word(rng.choice([15, 16, 17, 30, 60, 200])) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(shared)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p)))) if rng.random() < 0.5 else (0, len(p))
            p = list(p[a:b])
            if p and rng.random() < 0.4:
                p[rng.randrange(len(p))] = rng.choice("xyzä漢\0")
            parts += [word(rng.choice([0, 1, 5, 40])), "".join(p)]
        rows.append((i, "".join(parts)))
    return rows + [(1, None), (None, ""), (7, rows[3][1]), (None, rows[3][1]), (8, "a" * 300), (9, "ab" * 40 + "\0" * 50)]


@pytest.mark.parametrize("seed", range(4))
def test_repeats_of_short_strings(spark, seed):
    rows = passages(seed, letters="ab" if seed == 3 else "abcdefghij \n")
    got = repeats.without_repeats(texts_frame(spark, rows), least=16)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows, 16)


def test_anchors_with_many_contexts_give_the_same(spark):
    rows = passages(11)
    got = repeats.without_repeats(texts_frame(spark, rows), least=20, most=2, part_anchors=50)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows, 20)


def test_repeats_over_blocks_runs_and_chunks(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    shared = [word(n) for n in (199, 200, 201, 900)]
    rows = [(i, word(rng.choice([10, 300])) + rng.choice(shared) + word(rng.choice([0, 300]))) for i in range(50)]
    rows.append((50, "".join(word(1000) + shared[i % 4] for i in range(200))))  # longer than a block
    got = repeats.without_repeats(texts_frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows, 200)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=6), st.integers(16, 24))
def test_every_repeated_string_has_an_anchor_in_common(texts, least):
    whole, ends = "".join(texts).encode(), np.cumsum([len(t) for t in texts])
    place, h, _ = repeats.anchors(np.frombuffer(whole, np.uint8), ends, least)
    k, starts = repeats.piece_bytes(least), [0, *ends[:-1].tolist()]
    at = defaultdict(set)
    for a, b in zip(starts, ends.tolist(), strict=True):
        for s in range(a, b - least + 1):
            inside = {(int(p) - s, int(x)) for p, x in zip(place, h, strict=True) if s <= p <= s + least - k}
            assert inside
            at[whole[s : s + least]].add(frozenset(inside))
    for found in at.values():
        assert frozenset.intersection(*found)


@given(st.lists(st.integers(0, 6), max_size=40))
def test_intervals_are_the_tree(values):
    shared = np.array([0, *values], np.int64)
    want = {(int(min(shared[a + 1 : b + 1])), a, b) for a in range(len(shared)) for b in range(a + 1, len(shared))
            if (v := min(shared[a + 1 : b + 1])) >= 2 and shared[a] < v and (b + 1 == len(shared) or shared[b + 1] < v)}
    assert set(map(tuple, repeats.intervals(shared, 2).tolist())) == want


def test_groups_are_repeats_with_all_their_places(spark):
    rng = random.Random(9)
    word = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    p = word(24)
    rows = [(i, word(30) + left + p + right + word(30)) for i, (left, right) in enumerate([("", ""), ("x", ""), ("x", "yz"), ("wx", "yz"), ("", "y")])]
    texts = {k: t.encode() for k, t in rows}
    found = defaultdict(set)
    for r in repeats.repeat_groups(texts_frame(spark, rows), least=20).collect():
        found[r.repeat].add((r.doc_id, r.start, r.length))
    strings = {}
    for places in found.values():
        (one,) = {texts[d][s : s + n] for d, s, n in places}
        strings.setdefault(one, set()).update((d, s) for d, s, _ in places)
    assert strings[p.encode()] == {(d, texts[d].index(p.encode())) for d in texts}
    assert {d for d, _ in strings[("x" + p).encode()]} == {1, 2, 3}
    assert {d for d, _ in strings[("x" + p + "yz").encode()]} == {2, 3}
    for one, places in strings.items():
        assert len(one) >= 20 and places == {(d, s) for d, t in texts.items() for s in range(len(t)) if t[s : s + len(one)] == one}
    # Those that lie within the reach of one anchor can grow to neither side.
    for one in (p, "x" + p, "x" + p + "yz"):
        for side in (-1, len(one)):
            assert len({texts[d][s + side] for d, s in strings[one.encode()]}) > 1


def test_kept_texts_and_other_columns(spark):
    rows = [(1, "ab" + "x" * 30), (2, "ü" * 30)]
    frame = texts_frame(spark, rows).select("*", F.lit(1).alias("run"), F.lit(2).alias("hash"), F.lit("x").alias("id"))
    got = {r.doc_id: r for r in repeats.without_repeats(frame, least=16, with_text=True).collect()}
    assert got[1].kept == "ab" and got[2].kept == "" and got[2].n_removed == 60
    assert repeats.without_repeats(texts_frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        repeats.without_repeats(frame, least=8)
