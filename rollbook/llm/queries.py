"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import (
    alignment, bin_slack, chat, hard_negatives, html_density, licenses, line_spread, merkle, ngram_join, quality_rules, repeats, viterbi, warc,
)
from rollbook.session import shared_folder

RUN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        RUN[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_NORMAL = r"""regexp_replace(trim(lower(x), ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[0-9]+', '0', 'g')"""
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_LINES = f"""
row_of AS (SELECT row_number() OVER () AS rid, * FROM documents),
raw AS (SELECT rid, doc_id, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS x FROM row_of),
line AS (SELECT rid, doc_id, source, text, x AS raw, {_NORMAL} AS x FROM raw)"""

QUALITY = f"""
WITH {_LINES},
word AS (SELECT rid, unnest({_WORDS}) AS w, unnest(range(len({_WORDS}))) AS i FROM row_of),
gram AS (SELECT rid, i, string_agg(w, ' ') OVER g AS g, count(*) OVER g AS n FROM word
    WINDOW g AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
again AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS j FROM (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM gram WHERE n = 5) WHERE c > 1),
repeats AS (SELECT rid, sum(least(5, coalesce(j - i, 5))) AS r FROM again GROUP BY rid),
dups AS (SELECT rid, count(*) - count(DISTINCT raw) AS d FROM line WHERE x <> '' GROUP BY rid),
limits AS (SELECT source, x FROM line WHERE x <> '' GROUP BY source, x HAVING count(DISTINCT text) > 20),
lost AS (SELECT rid, sum(len(regexp_extract_all(line.x, '[^\x20\x09-\x0D]+'))) AS w FROM line JOIN limits
    ON line.x = limits.x AND line.source IS NOT DISTINCT FROM limits.source GROUP BY rid),
base AS (SELECT doc_id, rid, len({_WORDS}) AS n_words,
    length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(d, 0) AS n_dup_lines, CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words, coalesce(lost.w, 0) AS lost
    FROM row_of LEFT JOIN dups USING (rid) LEFT JOIN repeats USING (rid) LEFT JOIN lost USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - lost >= 5
        AND 100 * (n_words - lost) >= 25 * n_words AS kept
FROM base"""


@query("op8_quality_rules", QUALITY)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


SPREAD = """
WITH """ + _LINES.strip() + """,
wide AS (SELECT x FROM line WHERE x <> '' GROUP BY x HAVING count(DISTINCT coalesce('s' || source, '')) >= 10),
held AS (SELECT DISTINCT doc_id, text, x, length(x) AS n, x IN (SELECT x FROM wide) AS w FROM line WHERE x <> ''),
sides AS (SELECT max({'n': n, 'x': x}) FILTER (NOT w) AS own, coalesce(sum(n) FILTER (NOT w), 0) AS own_chars, sum(n) FILTER (w) AS wide_chars,
    list({'n': n, 'x': x} ORDER BY n DESC, x DESC) FILTER (w) AS shared FROM held GROUP BY doc_id, text HAVING bool_or(w)),
judged AS (SELECT own.x AS own, own_chars, wide_chars, shared[1].x AS first, shared[2].x AS second, unnest(shared) AS s FROM sides),
family AS (SELECT s.x AS x, coalesce(CASE WHEN 4 * own_chars >= wide_chars - s.n THEN own END, CASE WHEN s.x = first THEN second ELSE first END, own, '') AS family FROM judged),
spread AS (SELECT x FROM family GROUP BY x HAVING count(DISTINCT family) >= 10),
place AS (SELECT rid, doc_id, text, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM row_of WHERE text IS NOT NULL),
marked AS (SELECT p.rid, p.i, p.x, spread.x IS NOT NULL AS gone FROM
    (SELECT rid, i, x AS raw, """ + _NORMAL + """ AS n, x FROM place) p LEFT JOIN spread ON p.n = spread.x),
built AS (SELECT rid, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM marked GROUP BY rid)
SELECT row_of.doc_id, built.text, coalesce(n_removed, 0) AS n_removed FROM row_of LEFT JOIN built USING (rid)"""


@query("op10_line_spread", SPREAD)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return line_spread.without_spread(table(spark, folder, "documents")).select("doc_id", "text", "n_removed")


@query("op5_ngram_join")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked_classes(table(spark, folder, "documents"))


@query("op7_bin_slack")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return bin_slack.pack(table(spark, folder, "documents"))


REVISITS = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, html, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to FROM r"""


@query("op1_warc_chunks", REVISITS)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    warc.write_archives(warc.records(table(spark, folder, "pages")), path)
    return warc.record_summary(warc.read_chunks(spark, path, with_data=False))


CHATS = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
c AS (SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
    string_agg('<turn ' || replace(replace(replace(role, '\', '\s'), '<', '\l'), '>', '\g') || '>'
        || replace(replace(text, '\', '\s'), '<', '\l') || '</turn>' || chr(10), '') AS formatted
    FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, length(formatted) AS formatted_chars FROM c"""


@query("op2_chat_parts", CHATS)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(more)
    chats = chat.format_chats(turns.withColumn("parts", chat.text_parts(F.col("text"))))
    read = chats.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("loss")).alias("loss"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), F.array_join(t["texts"], ""), F.lit("\n"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op3_html_density")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return html_density.extract(table(spark, folder, "pages"))


@query("op4_merkle")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.compare_with_edits(table(spark, folder, "documents")).drop("edited_paragraphs")


@query("op6_streaming_viterbi")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return viterbi.round_trip(table(spark, folder, "documents"))


def _license_sql() -> str:
    """The scan in SQL: sentences cut and named, then one subquery per rule."""
    text = lambda x: "'" + x.replace("'", "''") + "'"
    white = licenses.WHITE
    candidates = ", ".join(f"{{'rank': {i}, 'name': '{name}', 'm': regexp_extract(x, {text(phrase)}, 0)}}" for i, (name, phrase) in enumerate(licenses.SENTENCES))
    state = "SELECT rid, coalesce(seq, '') AS rest, []::VARCHAR[] AS found FROM d LEFT JOIN q USING (rid)"
    for name, ids in licenses.RULES:
        part = "".join(f" {i} " for i in ids.split())
        state = f"""SELECT rid, replace(rest, '{part}', '') AS rest,
            CASE WHEN contains(rest, '{part}') AND NOT list_contains(found, '{name}') THEN list_append(found, '{name}') ELSE found END AS found FROM ({state})"""
    replaced = "coalesce(text, '')"
    for pattern, by in ((licenses.COMMENT, "''"), (licenses.COMMENT_END, "''"), (licenses.TAG_LINE, r"chr(10) || chr(10) || '\1' || chr(10) || chr(10)"),
                        (licenses.BLANK_LINES, "chr(1)"), (licenses.WRAP, "' '"), (f"([.!?]){white}+", r"'\1' || chr(1)")):
        replaced = f"regexp_replace({replaced}, {text(pattern)}, {by}, 'g')"
    known = ", ".join(f"'{n.lower()}': '{n}'" for n in licenses.SPDX)
    tag = licenses.TAG
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT rid, string_split(lower({replaced}), chr(1)) AS parts FROM d WHERE regexp_matches(lower(text), '{licenses.HINT}')),
u AS (SELECT rid, unnest(range(len(parts))) AS i, trim(regexp_replace(unnest(parts), '{white}+', ' ', 'g'), ' ') AS x FROM c),
f AS (SELECT rid, i, x, list_transform(list_filter([{candidates}], lambda c: c.m <> ''), lambda c: {{'s': strpos(x, c.m), 'rank': c.rank, 'n': length(c.m), 'name': c.name}}) AS p
    FROM u WHERE regexp_matches(x, '{licenses.HINT}') AND NOT starts_with(x, '{tag}')),
a AS (SELECT rid, i, x, list_filter(p, lambda c: len(list_filter(p, lambda e: e.rank < c.rank AND e.s < c.s + c.n AND c.s < e.s + e.n)) = 0) AS p FROM f),
o AS (SELECT rid, i, x, unnest(CASE WHEN len(list_filter(p, lambda c: c.name <> '{licenses.FALLBACK}')) > 0 THEN list_filter(p, lambda c: c.name <> '{licenses.FALLBACK}') ELSE p END) AS c FROM a),
n AS (SELECT rid, i, c.s AS j, c.rank AS k, c.name AS id FROM o WHERE NOT regexp_matches(substr(x, 1, c.s - 1), {text(licenses.DENIED)})),
g AS (SELECT rid, i, string_split(regexp_replace(regexp_replace(regexp_replace(substr(x, {len(tag) + 1}), '^ ?:', ''), ' with [^ ()]+', '', 'g'), '[()*/,;"'']|-->', ' ', 'g'), ' ') AS w
    FROM u WHERE starts_with(x, '{tag}')),
t AS (SELECT rid, i, j, regexp_replace(regexp_replace(w, '\+$', '-or-later'), '-only$', '') AS id FROM (SELECT rid, i, unnest(range(len(w))) AS j, unnest(w) AS w FROM g) WHERE w NOT IN ('', 'and', 'or')),
m AS (SELECT rid, i, j, id, map {{{known}}}[id] AS name FROM t),
b AS (SELECT rid, list(name ORDER BY i, j) FILTER (name IS NOT NULL) AS names, string_agg('spdx:' || id, ' ' ORDER BY i, j) FILTER (name IS NULL) AS unknown FROM m GROUP BY rid),
q AS (SELECT rid, string_agg(' ' || id || ' ', '' ORDER BY i, j, k) AS seq FROM n GROUP BY rid),
w AS (SELECT rid, string_agg(id, ' ' ORDER BY i, j, k) AS ids FROM (SELECT rid, i, j, k, id FROM n UNION ALL SELECT rid, i, j, 0, 'spdx:' || id FROM t) GROUP BY rid),
z AS ({state}),
y AS (SELECT rid, rest, found, list_concat(found, coalesce(names, [])) AS names, unknown FROM z LEFT JOIN b USING (rid))
SELECT doc_id, coalesce(ids, '') AS sentence_ids, array_to_string(list_filter(names, lambda v, i: list_position(names, v) = i), ',') AS licenses,
    trim(regexp_replace(rest || ' ' || coalesce(unknown, ''), ' +', ' ', 'g')) AS unmatched FROM d JOIN y USING (rid) LEFT JOIN w USING (rid)"""


@query("op9_license_rules", _license_sql())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


NEGATIVES = """
WITH r AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.rid <> b.rid),
p AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS nth FROM s WHERE same QUALIFY nth <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.rid, p.nth ORDER BY s.score DESC, s.vec_id) AS place,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON p.rid = s.rid AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score QUALIFY place <= 3)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n"""


@query("op11_strassen_negatives", NEGATIVES)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), label=label, anchor=F.col("vec_id") % 50 == 0)


@query("op12_spill_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


REPEATS = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT rid, o, substr(h, 2 * o + 1, 1398) AS x FROM (SELECT rid, h, unnest(range(0, length(h) // 2, 500)) AS o FROM d)),
w AS (SELECT rid, o + j AS i, hash(substr(x, 2 * j + 1, 400)) AS w FROM (SELECT rid, o, x, unnest(range(least(500, length(x) // 2 - 199))) AS j FROM c)),
t AS (SELECT w FROM w GROUP BY w HAVING count(*) > 1),
s AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM w SEMI JOIN t USING (w)),
n AS (SELECT rid, i, count(*) FILTER (p IS NULL OR i > p + 200) OVER (PARTITION BY rid ORDER BY i ROWS UNBOUNDED PRECEDING) AS nth FROM s),
r AS (SELECT rid, min(i) AS a, max(i) + 200 AS b FROM n GROUP BY rid, nth),
k AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS p FROM r),
g AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS b, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS kept
    FROM k JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(b, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN g USING (rid)"""


@query("op13_interval_tree", REPEATS)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(table(spark, folder, "documents"))
