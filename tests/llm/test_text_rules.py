"""Quality rules, line spread and licence rules against plain Python on small fixtures."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rollbook.llm import licenses, line_spread, quality_rules

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows, more: str = ""):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *extra) for i, t, s, *extra in rows], DOC + more)


def metrics(text):
    text = text or ""
    words = SPACE.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered.update(range(i, i + 5))
    lines, seen = 0, set()
    for line in text.split("\n"):
        if SPACE.search(line):
            lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(covered)


def made_text(rng, n):
    return " ".join(rng.choice("aa bb cc dd é# ff* 𝔘 gg\n hh\n").strip(" ") + rng.choice([" ", "\n", "\t", ""]) for _ in range(n))


def test_base_metrics(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "one", "a b c d e a b c d e", "a b c d e f\n" * 3, "x " * 500, "\n\nq\n\nq\n q", "word" * 4000]
    texts += [made_text(rng, rng.randint(1, 60)) for _ in range(40)] + [" ".join(rng.choice("abc") for _ in range(300))]
    out = quality_rules.judge(documents(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert len(out) == len(texts)
    for row in out:
        want = metrics(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want, texts[row.doc_id]
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def prose(seed, n=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_frequent_lines_reject_depleted_documents(spark):
    bar = "accept our cookies and our terms to go on reading this page today"
    rows = [(i, f"{bar}\n{prose(i)}", "hot") for i in range(30)]
    rows += [(100 + i, f"own {i} {i * 7}\n{bar}", "hot") for i in range(3)]  # little beside the bar
    rows += [(200 + i, f"own {i}\n{bar}", "quiet") for i in range(3)]  # the same on a host where it is rare
    rows += [(300 + i, f"{prose('copy')}\n{prose('copy2')}\n{prose('c3', 10 + i % 2)}", "hot") for i in range(60)]  # a text copied often stays
    rows += [(400, None, "hot"), (401, "", None), (402, f"{bar}\n{prose(1)}", None)]
    out = {r.doc_id: r for r in quality_rules.judge(documents(spark, rows)).collect()}
    assert all(out[i].kept and out[i].words_left == 40 for i in range(30))
    assert all(not out[100 + i].kept and not out[100 + i].base_failed for i in range(3))
    assert all(out[200 + i].kept for i in range(3))
    assert all(out[300 + i].kept for i in range(60))
    assert not out[400].kept and not out[401].kept and out[402].kept


def test_a_host_of_depleted_documents_only(spark):
    banner = prose("banner", 30)
    rows = [(i, f"{banner}\nown {prose(i, 6)}", "hot") for i in range(25)]
    rows += [(100 + i, f"{prose('same')}\n{prose('same2')}", "hot") for i in range(40)]  # exact copies count once
    rows += [(200 + i, f"{prose('near')}\n{prose('near2')}\n{prose(f'n{i}', 3)}", "other") for i in range(60)]  # and many copies
    rows += [(300 + i, f"{banner}\n{prose(f'u{i}', 90)}", "other") for i in range(25)]  # beside the banner's own texts
    rows += [(400 + i, f"{banner}\n{prose('near')}\n{prose(f'm{i}', 60)}", "other") for i in range(60)]
    out = {r.doc_id: r for r in quality_rules.judge(documents(spark, rows)).collect()}
    assert all(not out[i].kept and out[i].words_left == 7 and out[i].lines_over == 1 for i in range(25))
    assert all(out[100 + i].kept for i in range(40))
    assert all(out[300 + i].kept and out[300 + i].words_left == 90 for i in range(25))
    assert all(out[400 + i].kept and out[400 + i].words_left == 60 for i in range(60))


def test_keep_good_returns_the_rows_as_they_are(spark):
    rows = [(1, prose(1), "a", 7), (1, prose(1), "a", 7), (2, "short", "a", 8), (None, prose(3), None, None), (3, None, "a", 9)]
    docs = documents(spark, rows, ", mark int")
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.mark or -1) for r in kept.collect()) == [(-1, -1), (1, 7), (1, 7)]
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


def spread_truth(rows, least=10):
    def normal(x):
        return re.sub("[0-9]+", "0", x.lower().strip(" \t\n\x0b\x0c\r"))

    held, family = defaultdict(set), {}
    for _, t, s in rows:
        lines = [normal(x) for x in (t or "").split("\n")]
        family[t] = max((len(x), x) for x in lines)
        for x in lines:
            held[x].add((s, t, family[t]))
    out = []
    for i, t, _ in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        keep = []
        for x in t.split("\n"):
            h = held[normal(x)]
            fam = len({f for _, _, f in h})
            wide = normal(x) != "" and len({s for s, _, _ in h}) >= least and fam >= least and 2 * fam >= len({c for _, c, _ in h})
            keep += [] if wide else [x]
        out.append((i, "\n".join(keep), len(t.split("\n")) - len(keep)))
    return sorted(out, key=repr)


def test_line_spread_equals_brute_force(spark):
    rows = []
    for i in range(40):
        lines = [prose(i, 12), "Share THIS page 12 times", prose(f"b{i}", 12), "", "read more" if i % 20 < 9 else f"no {i}", "  share this page 7 times"]
        rows.append((i, "\n".join(lines), f"s{i % 20}"))
    rows += [(100 + i, f"{prose('c')}\n{prose('d')}\n{prose(i, 3)}", f"s{i}") for i in range(20)]  # copies over all sites
    rows += [(200, None, "s1"), (201, "", "s1"), (202, "Share this page 9 times", None), (0, rows[0][1], "s0")]
    got = line_spread.without_spread(documents(spark, rows)).select("doc_id", "text", "n_removed").collect()
    assert sorted(map(tuple, got), key=repr) == spread_truth(rows)
    assert any(r.n_removed == 2 for r in got) and all(not r.n_removed for r in got if 100 <= r.doc_id < 120)


def test_line_spread_of_long_notices_and_beside_many_copies(spark):
    notice, footer = prose("notice", 60), "find us on all the usual pages"
    rows = [(i, f"{notice}\n{prose(i, 4)}\n{prose(f'n{i}', 3)}", f"s{i}") for i in range(15)]  # the notice is the longest line
    rows += [(100 + i, f"{prose(f'p{i}')}\n{footer}", f"s{i}") for i in range(15)]  # a footer below unlike pages
    page = [prose(f"page{k}", 20 + k) for k in range(12)]
    for i in range(60):  # and below near copies of one page
        page_now = [prose(f"new{i}", 20) if k == i % 12 else x for k, x in enumerate(page)]
        rows.append((200 + i, "\n".join([*page_now, footer]), f"s{i % 20}"))
    got = {r.doc_id: r for r in line_spread.without_spread(documents(spark, rows)).collect()}
    assert all(r.n_removed == 1 for r in got.values())
    assert all(notice not in r.text and footer not in r.text for r in got.values())


def test_line_spread_keeps_columns_and_takes_empty_tables(spark):
    docs = documents(spark, [(1, "a\nb", "x", "m", "d")], ", mark string, drops string")
    out = line_spread.without_spread(docs)
    assert out.columns == [*docs.columns, "n_removed"] and out.count() == 1
    assert line_spread.without_spread(docs.limit(0)).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal.
The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""


@pytest.mark.parametrize(
    ("text", "ids", "found", "unmatched"),
    [
        (None, "", "", ""), ("", "", "", ""), ("plain prose with no such thing", "", "", ""),
        (MIT, "MITPermission MITNotice MITAsIs", "MIT", ""),
        ("x y.\nLicensed under the Apache License, Version 2.0.\nmore", "ApacheRef", "Apache-2.0", ""),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL3", "GPL-3.0", ""),
        ("This is under the GNU General Public License version 2\nor (at your option) any later version.", "GPLOrLater2", "GPL-2.0-or-later", ""),
        ("Licensed under CC BY-NC 4.0. Released under the MIT License. Released under the MIT License.", "CCBYNC MITRef MITRef", "MIT,CC-BY-NC-4.0", "MITRef"),
        ("All rights reserved.\nLicensed under terms of ours.", "Proprietary OtherLicence", "All-rights-reserved", "OtherLicence"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted. Redistributions of source code must retain "
         "the above copyright notice. Redistributions in binary form must reproduce the above copyright notice.", "BSDRedistribution BSDSource BSDBinary", "BSD-2-Clause", ""),
    ],
)
def test_license_rules(spark, text, ids, found, unmatched):
    row = licenses.scan(documents(spark, [(1, text, "s")])).first()
    assert (row.sentence_ids, row.licenses) == (ids, found)
    assert row.unmatched in (unmatched, "")


def test_license_scan_keeps_every_row(spark):
    docs = documents(spark, [(1, MIT, "s"), (1, MIT, "s"), (None, None, None)])
    assert licenses.scan(docs).count() == 3 and licenses.scan(docs.limit(0)).count() == 0
    assert licenses.scan(docs.withColumn("rest", F.lit(1))).columns == ["doc_id", "sentence_ids", "licenses", "unmatched"]
