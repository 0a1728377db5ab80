"""N-gram join, packing, Viterbi and the pipeline against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm import bin_slack, ngram_join, viterbi
from rollbook.llm.components import components
from rollbook.llm.shingles import shingle_sets

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[i : i + size]) for i in range(len(w) - size + 1)])


def classes(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)].append(key)
    return sorted(((key, len(sets[i]), min(least[find(i)], default=None)) for i, (key, _) in enumerate(rows)), key=repr)


def copies(seed=1, families=12, members=12):
    """Families of texts with few to many words changed, chains included, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    rows = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([1, 2, 3, 8, 11, 12, 20, 35, 80, 200, 400]))]
        for _ in range(members):
            now = list(base)
            for _ in range(rng.randint(0, max(1, len(now) // 25))):
                k = rng.randrange(max(1, len(now)))
                now[k : k + rng.randint(0, 1)] = [word()] * rng.randint(0, 2)
            if rng.random() < 0.4:
                base = now
            rows.append(" ".join(now))
    passage = " ".join(word() for _ in range(60))
    rows += [f"{passage} {' '.join(word() for _ in range(rng.randint(1, 30)))}" for _ in range(15)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_shingle_sets():
    texts = [t for _, t in copies(2)] + [None, "", " ", "A b", "a B", "A b c a b c a", "é\x0b ü\t\n x  y"]
    got = shingle_sets([None if t is None else t.encode() for t in texts])
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]
    assert (got[-4] == got[-3]).all()


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for n in [*range(1, 60), 100, 300, 1000]:
        base = np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
        for _ in range(6):
            cut = rng.integers(0, n // 10 + 2)
            other = np.unique(np.concatenate((rng.permutation(base)[cut:], rng.integers(1, 2**63, rng.integers(0, n // 12 + 2), dtype=np.uint64))))
            both = len(np.intersect1d(base, other))
            if 0 < len(other) and both < max(len(base), len(other)) and 100 * both >= percent * (len(base) + len(other) - both):
                assert np.intersect1d(ngram_join.signatures(base, percent), ngram_join.signatures(other, percent)).size


@pytest.mark.parametrize("percent", [60, 90])
def test_prefix_tree(percent):
    rows = copies(3, 4, 20)
    sets = [s for s in shingle_sets([t.encode() for _, t in rows]) if len(s)]
    got = ngram_join.PrefixTree(sets, percent).classes()
    groups = defaultdict(list)
    for i, g in enumerate(got):
        groups[g].append(i)
    want = {k: c for k, _, c in classes(rows, percent)}
    assert sorted(map(sorted, groups.values())) == sorted(sorted(k for k in want if want[k] == c) for c in set(want.values()))


@pytest.mark.parametrize(("seed", "block"), [(1, 2_000_000), (4, 3000), (7, 300)])
def test_linked_classes(spark, seed, block):
    rows = copies(seed) + [(1000, None), (1001, ""), (1002, " \n"), (None, "only null id here"), (1003, "Only NULL id here"), (1004, "x y"), (1004, "x y"), (5, "p q r s")]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, key int, node string")
    got = ngram_join.linked_classes(docs, block_tokens=block)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == classes(rows)


def test_join_of_nothing_and_kept_documents(spark):
    docs = spark.createDataFrame([(3, "a b c d"), (1, "A b c d"), (2, None), (None, "a b c d"), (4, "e f g h")], "doc_id long, text string").withColumn("gone_id", F.lit(0))
    assert ngram_join.linked_classes(docs.limit(0)).count() == 0
    assert sorted((r.doc_id or 0) for r in ngram_join.keep_first(docs.drop("gone_id")).collect()) == [0, 1, 2, 4]


def test_an_id_with_two_texts_loses_the_copy_only(spark):
    rows = [(1, "a b c d e"), (2, "A b c d e"), (2, "p q r s t"), (3, "f g h i j"), (3, "F g h i j"), (4, "k l m n o"), (4, "k l m n o"), (5, None), (5, "a b c d E")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, mark string")
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "").lower()) for r in kept.collect()))
    assert got == [(1, "a b c d e"), (2, "p q r s t"), (3, "f g h i j"), (4, "k l m n o"), (4, "k l m n o"), (5, "")]


def test_one_row_of_each_class_stays(spark):
    rows = [(1, "a b c d e"), (2, "A b c d e"), (1, "a b c d e"), (4, "k l m n o"), (4, "k l m n o"), (None, "k l m n o"), (None, "p q r s"), (None, "P q r s"), (5, None), (5, None), (6, " "), (None, "")]
    docs = spark.createDataFrame([(i, t, n, {"a": n}) for n, (i, t) in enumerate(rows)], "doc_id long, text string, nth int, mark map<string,int>")
    kept = ngram_join.keep_first(docs, single=True)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "").lower().strip()) for r in kept.collect()), key=repr)
    assert got == [(1, "a b c d e"), (4, "k l m n o"), (5, ""), (5, ""), (6, ""), (None, ""), (None, "p q r s")]


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sizes_share_a_range(spark, percent):
    n = spark.range(1, 3000).select(F.col("id").alias("n"), ngram_join._ranges(F.col("id"), percent).alias("r"))
    ranges = {x.n: set(x.r) for x in n.collect()}
    assert all(ranges[a] & ranges[b] for a in range(1, 3000, 7) for b in range(a, min(2999, a * 100 // percent) + 1))


@pytest.mark.parametrize("block", [2_000_000, 200])
def test_links_between_ranges_are_kept(spark, block):
    rows = []
    for n in (62, 254, 1020):
        base = [f"w{n}x{k}" for k in range(n + 2)]
        rows += [(len(rows) + k, " ".join([*base, *[f"more{n}x{i}" for i in range(k * n // 62)]])) for k in range(5)]
    got = ngram_join.linked_classes(spark.createDataFrame(rows, "doc_id long, text string"), block_tokens=block)
    assert sorted(map(tuple, got.collect()), key=repr) == classes(rows)
    assert len({r[2] for r in classes(rows)}) == 3


def test_rows_without_an_id_are_fetched_once(spark):
    rows = copies(5, 6, 10)
    docs = spark.createDataFrame([(None if k % 3 == 0 else k, t) for k, t in rows] + [(None, rows[0][1])] * 200, "doc_id long, text string").repartition(4)
    want = classes([(None if k % 3 == 0 else k, t) for k, t in rows] + [(None, rows[0][1])] * 200)
    assert sorted(map(tuple, ngram_join.linked_classes(docs).collect()), key=repr) == want


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, i) for i in range(2001, 2200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in want.items() if k in got} and {k for k in want if want[k] != k} <= set(got)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_fullest_is_optimal():
    rng = random.Random(11)
    for _ in range(200):
        counts = Counter(rng.randint(1, 30) for _ in range(rng.randint(1, 8)))
        room = rng.randint(1, 60)
        best = {0}
        for n in counts.elements():
            best |= {b + n for b in best if b + n <= room}
        bin_ = bin_slack.fullest(room, counts, sorted(counts, reverse=True))
        assert sum(n * k for n, k in bin_.items()) == max(best) and all(k <= counts[n] for n, k in bin_.items())


def test_pack(spark):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    rng = random.Random(1)
    texts = [" ".join(rng.choice(["word", "né", "<|endoftext|>", "日本", "1234", "\n\n"]) for _ in range(rng.choice([0, 3, 40, 200, 900]))) for _ in range(120)] + [None, "", "a" * 9000, "same", "same"]
    docs = spark.createDataFrame([(i if i != 5 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, rank int").repartition(5)
    rows = bin_slack.pack(docs).collect()
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        mine = sorted(pieces[i if i != 5 else None], key=lambda r: r.piece)
        assert sum(r.length for r in mine) == len(ids) and [r.piece for r in mine] == list(range(-(-len(ids) // 1024)))
        assert all(r.length == 1024 for r in mine[1:])
        for r in mine:
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    for cuts in bins.values():
        at = 0
        for offset, length in sorted(cuts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert -(-total // 1024) <= len(bins) <= -(-total // 1024) + 2
    assert bin_slack.pack(docs.limit(0)).count() == 0


def test_fast_ids_equal_the_standard():
    encoder = bin_slack.public_encoder()
    rng = random.Random(8)
    every = [chr(c) for c in range(256)]
    texts = ["".join(rng.choice(every) for _ in range(60)) for _ in range(1500)] + ["".join(every), "it's WE'LL  x\n\n y", "<|endoftext|>a<|endoftext|>", " " * 700, "a" * 3000]
    texts += ["".join(rng.choice("ab '\n\x85\xa0\t1²ªµé.<|endoftext|>") for _ in range(40)) for _ in range(1500)]
    for t in texts:
        assert encoder(t) == encoder.standard.encode(t, add_special_tokens=False).ids, repr(t)


def tiny_pieces():
    names = ["<unk>", "▁", "a", "b", "ab", "ba", "aba", "▁a", "▁▁", "bab"]
    return viterbi.Pieces(names, [0.0, -2.0, -3.0, -3.0, -2.5, -2.5, -4.0, -2.2, -3.0, -4.1], ["other"] + ["piece"] * 9)


def best_split(pieces, text):
    best = [(0, [])] + [None] * len(text)
    flat = {n: i for i, n in enumerate(pieces.names) if pieces.kinds[i] == "piece"}
    score = {}
    for n in flat:
        node = pieces.trie
        for c in n:
            node = node[0](c)
        score[n] = node[2]
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - pieces.longest), j):
            cut = text[i:j]
            if cut in flat:
                ids, s = [flat[cut]], score[cut]
            elif len(cut) == 1:
                ids, s = pieces.spelled(cut), pieces.unknown
            else:
                continue
            if best[j] is None or best[i][0] + s > best[j][0]:
                best[j] = (best[i][0] + s, best[i][1] + ids)
    return best[-1][1]


def test_streaming_equals_the_whole_text():
    pieces, rng = tiny_pieces(), random.Random(2)
    search = viterbi.StreamingViterbi(pieces)
    for _ in range(300):
        text = "".join(rng.choice("ab▁x\n") for _ in range(rng.randint(0, 80)))
        ids, at = [], 0
        while at < len(text):
            step = rng.randint(1, 9)
            ids += search.feed(text[at : at + step])
            at += step
        assert ids + search.end() == best_split(pieces, text)
    for _ in range(3000):
        search.feed("".join(rng.choice("ab") for _ in range(5)))
    assert search.widest < 120


def test_codec_round_trip_and_parts():
    codec, rng = viterbi.public_codec(), random.Random(4)
    texts = ["", " ", "a", "  two  blanks ", "line\nline\n\n", "日本語 😀 é", "x" * 5000, "\x00\x07", "ab " * 50]
    texts += ["".join(rng.choice("the and of \n  éß") for _ in range(200)) for _ in range(30)]
    whole = viterbi.Codec(codec.p)
    whole.parted = False
    for t in texts:
        ids = codec.encode(t)
        assert codec.decode(ids) == t and ids == whole.encode(t) == best_split(codec.p, viterbi.BLANK + t.replace(" ", viterbi.BLANK) if t else "")


def test_unigram_model_keeps_its_scores():
    class Model:
        def get_piece_size(self): return 3
        def is_byte(self, i): return False
        def is_control(self, i): return False
        def is_unknown(self, i): return i == 0
        def is_unused(self, i): return False
        def id_to_piece(self, i): return ["<unk>", "a", "aa"][i]
        def get_score(self, i): return [0.0, -1.5, -2.75][i]
        def unk_id(self): return 0

    pieces = viterbi.Pieces.of(Model())
    assert pieces.trie[0]("a")[1:] == (1, -1500000) and pieces.unknown == -12750000


def test_viterbi_rows(spark):
    docs = spark.createDataFrame([(1, "some text"), (1, "some text"), (None, None), (2, "")], "doc_id long, text string").withColumn("ids", F.lit(1))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in viterbi.round_trip(docs).collect()) == [(0, 0), (1, 2), (1, 2), (2, 0)]
    back = viterbi.decode(viterbi.encode(docs))
    assert sorted(r.text for r in back.collect()) == ["", "", "some text", "some text"]
    assert viterbi.round_trip(docs.limit(0)).count() == 0
