"""Licence scans by sentences and rules.

Comment marks go, wrapped lines are joined, and the text is cut into sentences. A sentence gets the identifiers of all
known licence sentences found in it at different places, but for those that are said not to hold. The identifiers of
a document, in order, are matched against rules in order: a rule takes the identifiers it names away, so a later,
more general rule doesn't see them again. What no rule takes is reported. Of an SPDX tag each name is an identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.shared import let

# Phrases of public licence texts, lower case, white space as one blank, as regular expressions.
SENTENCES = [
    ("ApacheRef", r"(under|of|or|and|and/or) (the )?(terms of )?(the )?apache licen[sc]e,? (version )?2\.0|apache[- ]2\.0 licen[sc]e"),
    ("ApacheMayNot", r"you may not use this file except in compliance with the license"),
    ("ApacheObtain", r"you may obtain a copy of the license at"),
    ("AsIsUnless", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an"),
    ("MITRef", r"(under|of|or|and|and/or) (the )?(terms of )?(the )?mit licen[sc]e"),
    ("MITPermission", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MITNotice", r"the above copyright notice and this permission notice shall be included"),
    ("MITAsIs", r"the software is provided .?as is.?, without warranty of any kind"),
    ("GPLOrLater3", r"gnu general public license.{0,80}(version 3|v3).{0,60}any later version"),
    ("GPLOrLater2", r"gnu general public license.{0,80}(version 2|v2).{0,60}any later version"),
    ("AGPLOrLater3", r"gnu affero general public license.{0,80}(version 3|v3).{0,60}any later version"),
    ("LGPLOrLater3", r"gnu lesser general public license.{0,80}(version 3|v3).{0,60}any later version"),
    ("LGPLOrLater21", r"gnu lesser general public license.{0,80}(version 2\.1|v2\.1).{0,60}any later version"),
    ("LGPL3", r"gnu lesser general public license,? (version 3|v3)"),
    ("LGPL21", r"gnu lesser general public license,? (version 2\.1|v2\.1)"),
    ("AGPL3", r"gnu affero general public license,? (version 3|v3)"),
    ("GPL3", r"gnu general public license,? (version 3|v3)"),
    ("GPL2", r"gnu general public license,? (version 2|v2)"),
    ("GPLNoWarranty", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("BSDRedistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSDSource", r"redistributions of source code must retain the above copyright notice"),
    ("BSDBinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BSDEndorse", r"may be used to endorse or promote products derived from this software"),
    ("BSDAsIs", r"this software is provided by .{0,80}as is.{0,20}and any express or implied warranties"),
    ("BSDRef", r"(under|of|or|and|and/or) (the )?(terms of )?(the |a )?(bsd|new bsd|3-clause bsd|bsd 3-clause) licen[sc]e"),
    ("BSD2Ref", r"(under|of|or|and|and/or) (the )?(terms of )?(the |a )?(simplified bsd|2-clause bsd|bsd 2-clause) licen[sc]e"),
    ("ISCPermission", r"permission to use, copy, modify, and(/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("MPLRef", r"subject to the terms of the mozilla public license|licensed under the mozilla public license"),
    ("CCBYNCSA", r"cc by-nc-sa ?4\.0|attribution-noncommercial-sharealike 4\.0"),
    ("CCBYNCND", r"cc by-nc-nd ?4\.0|attribution-noncommercial-noderivatives 4\.0"),
    ("CCBYNC", r"cc by-nc ?4\.0|attribution-noncommercial 4\.0"),
    ("CCBYSA", r"cc by-sa ?4\.0|attribution-sharealike 4\.0"),
    ("CCBYND", r"cc by-nd ?4\.0|attribution-noderivatives 4\.0"),
    ("CCBY", r"cc by ?4\.0|creative commons attribution 4\.0"),
    ("CC0", r"cc0 1\.0|creative commons zero|public domain dedication"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain"),
    ("Proprietary", r"all rights reserved|proprietary and confidential|unauthorized copying of this"),
    ("OtherLicence", r"licensed under|released under the .{0,40}licen[sc]e"),
]
#: Counts only in a sentence where nothing else is found.
FALLBACK = "OtherLicence"
# Names of the SPDX list that tags are known by.
SPDX = """0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0
CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-1.0 GPL-2.0
GPL-2.0-or-later GPL-3.0 GPL-3.0-or-later ISC LGPL-2.0 LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0
MS-PL NCSA OFL-1.1 OpenSSL PostgreSQL PSF-2.0 Python-2.0 Unlicense UPL-1.0 WTFPL X11 Zlib""".split()
TAG = "spdx-license-identifier"
# What stands before a phrase that does not hold.
DENIED = r"(^| )(not|never|no longer|neither|isn't|aren't)( be| been| currently| yet)?( (re)?(licensed|released|distributed|available|published|provided|covered)( under| by)?( either of| any of| the terms of)?( the)?)? ?$"
#: White space of the patterns below.
WHITE = r"[ \t\n\x0B\f\r]"
COMMENT = r"(?m)^[ \t]*(/\*+|\*+/?|//+|#+|--+|;+|%+|<!--)[ \t]*"
COMMENT_END = r"(?m)[ \t]*(\*+/|-->)[ \t\r]*$"
TAG_LINE = r"(?i)(spdx-license-identifier[ \t]*:[^\n]*)"
BLANK_LINES = r"[ \t\r]*\n[ \t\r]*(\n[ \t\r]*)+"
WRAP = r"[ \t\r]*\n[ \t\r]*"
# Sequences of identifiers, long ones first; any rights statement counts when nothing else does.
RULES = [
    ("Apache-2.0", "ApacheRef ApacheMayNot ApacheObtain AsIsUnless"), ("Apache-2.0", "ApacheRef ApacheMayNot"), ("Apache-2.0", "ApacheRef"),
    ("MIT", "MITPermission MITNotice MITAsIs"), ("MIT", "MITPermission MITAsIs"), ("MIT", "MITPermission MITNotice"), ("MIT", "MITPermission"),
    ("MIT", "MITRef"), ("BSD-2-Clause", "BSD2Ref"),
    ("BSD-3-Clause", "BSDRedistribution BSDSource BSDBinary BSDEndorse BSDAsIs"), ("BSD-3-Clause", "BSDRedistribution BSDSource BSDBinary BSDEndorse"),
    ("BSD-2-Clause", "BSDRedistribution BSDSource BSDBinary BSDAsIs"), ("BSD-2-Clause", "BSDRedistribution BSDSource BSDBinary"),
    ("BSD-1-Clause", "BSDRedistribution BSDSource"), ("BSD-3-Clause", "BSDRef"), ("ISC", "ISCPermission"),
    ("GPL-3.0-or-later", "GPLOrLater3 GPLNoWarranty"), ("GPL-3.0-or-later", "GPLOrLater3"),
    ("GPL-2.0-or-later", "GPLOrLater2 GPLNoWarranty"), ("GPL-2.0-or-later", "GPLOrLater2"),
    ("AGPL-3.0-or-later", "AGPLOrLater3"), ("LGPL-3.0-or-later", "LGPLOrLater3"), ("LGPL-2.1-or-later", "LGPLOrLater21"),
    ("LGPL-3.0", "LGPL3"), ("LGPL-2.1", "LGPL21"), ("AGPL-3.0", "AGPL3"), ("GPL-3.0", "GPL3"), ("GPL-2.0", "GPL2"), ("MPL-2.0", "MPLRef"),
    ("CC-BY-NC-SA-4.0", "CCBYNCSA"), ("CC-BY-NC-ND-4.0", "CCBYNCND"), ("CC-BY-NC-4.0", "CCBYNC"), ("CC-BY-SA-4.0", "CCBYSA"),
    ("CC-BY-ND-4.0", "CCBYND"), ("CC-BY-4.0", "CCBY"), ("CC0-1.0", "CC0"), ("Unlicense", "Unlicense"), ("All-rights-reserved", "Proprietary"),
]
#: A text without one of these words has no sentence of the table, so it is not cut.
HINT = r"licen[sc]|permission|warrant|redistribution|gnu |cc by|cc0|creative commons|attribution|rights reserved|public domain|proprietary|unauthorized copying|endorse|obtain a copy"


def sentences(text: Column) -> Column:
    """Normalised sentences in order: lower case, white space runs as one blank.

    Comment marks at the ends of lines go. A line belongs to the sentence of the line before, unless a blank line
    stands between them or an SPDX tag, which is a sentence of its own. Sentences end after ``.!?`` before white space.
    """
    out = F.regexp_replace(F.coalesce(text, F.lit("")), COMMENT, "")
    out = F.regexp_replace(F.regexp_replace(out, COMMENT_END, ""), TAG_LINE, "\n\n$1\n\n")
    out = F.regexp_replace(F.regexp_replace(out, BLANK_LINES, "\x01"), WRAP, " ")
    cut = F.regexp_replace(out, f"([.!?]){WHITE}+", "$1\x01")
    return F.transform(F.split(F.lower(cut), "\x01"), lambda s: F.btrim(F.regexp_replace(s, f"{WHITE}+", " ")))


def sentence_ids(sentence: Column) -> Column:
    """Identifiers of the known sentences found in it, by place; of matches that overlap, that which the table has first."""
    found = F.array(*[
        F.struct(F.lit(i).alias("rank"), F.lit(name).alias("name"), F.regexp_extract(sentence, phrase, 0).alias("m")) for i, (name, phrase) in enumerate(SENTENCES)
    ])
    placed = F.transform(
        F.filter(found, lambda c: c["m"] != ""),
        lambda c: F.struct(F.position(c["m"], sentence).alias("s"), c["rank"].alias("rank"), F.length(c["m"]).alias("n"), c["name"].alias("name")),
    )

    def apart(all_: Column) -> Column:
        return F.filter(all_, lambda c: ~F.exists(all_, lambda e: (e["rank"] < c["rank"]) & (e["s"] < c["s"] + c["n"]) & (c["s"] < e["s"] + e["n"])))

    def told(some: Column) -> Column:
        others = F.filter(some, lambda c: c["name"] != FALLBACK)
        holds = lambda c: ~F.substring(sentence, 1, c["s"] - 1).rlike(DENIED)
        return F.transform(F.array_sort(F.filter(F.when(F.size(others) > 0, others).otherwise(some), holds)), lambda c: c["name"])

    return let(let(placed, apart), told)


def tag_names(sentence: Column) -> Column:
    """The names of an SPDX expression, lower case: ``+`` is or-later, ``-only`` is as without, exceptions are left out."""
    names = F.regexp_replace(F.regexp_replace(F.substring(sentence, len(TAG) + 1, F.length(sentence)), "^ ?:", ""), " with [^ ()]+", "")
    parts = F.split(F.regexp_replace(names, r"[()*/,;\"']|-->", " "), " ")
    plain = F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(x, r"\+$", "-or-later"), "-only$", ""))
    return F.filter(plain, lambda x: ~x.isin("", "and", "or"))


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ``sentence_ids`` (joined by blanks), ``licenses`` (distinct, in rule order, then those of tags, joined by commas), ``unmatched``.

    ``unmatched`` has the identifiers that no rule took and the tag names that are not known, joined by blanks. A
    tag's names are identifiers that begin with ``spdx:``. Null and blank texts have empty strings; repeated rows
    and null ids stay rows of their own. Documents don't depend on each other, so nothing is shuffled; sentences
    are only cut in documents that hold a word of ``HINT``, and a very long text is one value.
    """
    hint = F.lower(F.coalesce(F.col(text), F.lit(""))).rlike(HINT)
    short = F.filter(sentences(F.col(text)), lambda s: s.rlike(HINT))
    tagged = lambda s: F.startswith(s, F.lit(TAG))
    each = F.transform(short, lambda s: F.when(tagged(s), F.transform(tag_names(s), lambda x: F.concat(F.lit("spdx:"), x))).otherwise(sentence_ids(s)))
    found = docs.select(F.col(id), F.when(hint, F.flatten(each)).otherwise(F.array().cast("array<string>")).alias("ids"))
    tag = lambda x: F.startswith(x, F.lit("spdx:"))
    plain = F.filter("ids", lambda x: ~tag(x))
    names = F.transform(F.filter("ids", tag), lambda x: F.substring(x, 6, F.length(x)))
    state = found.select(
        id, F.array_join("ids", " ").alias("sentence_ids"), names.alias("names"),
        F.when(F.size(plain) == 0, "").otherwise(F.concat(F.lit(" "), F.array_join(plain, "  "), F.lit(" "))).alias("rest"),
    )
    # The sequence is " A  B ": each identifier with a blank at both sides, so a rule is a plain substring.

    def step(acc: Column, rule: Column) -> Column:
        hit = F.contains(acc["rest"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(acc["rest"], rule["ids"], F.lit(""))).otherwise(acc["rest"]).alias("rest"),
            F.when(hit & ~F.array_contains(acc["found"], rule["name"]), F.array_append(acc["found"], rule["name"])).otherwise(acc["found"]).alias("found"),
        )

    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f" {i} " for i in ids_.split())).alias("ids")) for name, ids_ in RULES])
    start = F.struct(F.col("rest").alias("rest"), F.array().cast("array<string>").alias("found"))
    applied = F.when(F.col("rest") != "", F.aggregate(rules, start, step))
    known = F.array(*[F.lit(n) for n in SPDX])
    listed = F.array(*[F.lit(n.lower()) for n in SPDX])
    by_tag = F.transform(F.filter("names", lambda x: F.array_contains(listed, x)), lambda x: F.get(known, (F.array_position(listed, x) - 1).cast("int")))
    unknown = F.transform(F.filter("names", lambda x: ~F.array_contains(listed, x)), lambda x: F.concat(F.lit("spdx:"), x))
    none = F.array().cast("array<string>")
    rest = F.regexp_replace(F.concat_ws(" ", F.coalesce("x.rest", F.lit("")), F.array_join("unknown", " ")), " +", " ")
    return state.select(id, "sentence_ids", applied.alias("x"), by_tag.alias("by_tag"), unknown.alias("unknown")).select(
        id, "sentence_ids", F.array_join(F.array_distinct(F.concat(F.coalesce("x.found", none), "by_tag")), ",").alias("licenses"), F.btrim(rest).alias("unmatched")
    )
