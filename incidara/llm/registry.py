"""One registered query per operator, and the SQL that checks it."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe,
    decontaminate,
    kdshards,
    lines,
    neighbours,
    phrases,
    pii,
    repeats,
    secretscan,
    simhash,
    spelling,
    toxicity,
    warc,
)
from .common import read


def tokenizer_source(path: str | None = None) -> str:
    """The JSON text of a tokenizer; the public byte-level one unless a path is given."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Path(path).read_text()


def op1_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_suffix_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: Of the registered query; a deployment passes its own secret.
PII_KEY = b"registered query"


def op3_surrogate_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.audit(read(spark, sf_dir, "documents"), PII_KEY)


def op4_instance_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_column_wise_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.audit(read(spark, sf_dir, "documents"), with_text=True)


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_source())


def op8_line_run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.audit(read(spark, sf_dir, "documents"))


def op9_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdshards.shards(read(spark, sf_dir, "documents"))


def op10_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_round_trip(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(read(spark, sf_dir, "documents"))


def op12_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.audit(read(spark, sf_dir, "documents"))


def op13_partenum_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_block_matrix_neighbours,
        op2_suffix_automaton_decontamination,
        op3_surrogate_pii,
        op4_instance_toxicity,
        op5_golay_simhash,
        op6_column_wise_repeats,
        op7_bpe_transducer,
        op8_line_run_dedup,
        op9_kd_tree_shards,
        op10_warc_index_merge,
        op11_trie_collocations,
        op12_trigram_secret_scan,
        op13_partenum_spellings,
    )
}

_WORDS = """regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

def _secrets() -> str:
    """Spans by the pieces between matches; the rules are the operator's, read by DuckDB."""
    found = []
    for number, rule in enumerate(secretscan.RULES):
        pattern = rule.pattern.replace("'", "''").replace("(?<![A-Za-z0-9_-])", "")
        if rule.any_case:
            pattern = "(?i)" + pattern
        if rule.kind == "hex":  # the same runs, found without stopping at the short ones
            pattern = f"{pattern[:-1]}{{{rule.least},}}"
        found.append(f"""
    SELECT doc_id, {number} AS rule, '{rule.kind}' AS kind, {rule.kind in secretscan.BASE} AS base, {rule.least} AS least,
        string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS found,
        regexp_extract_all(text, '{pattern}', {rule.group}) AS judged FROM d""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(found)}),
e AS (
    SELECT doc_id, rule, kind, base, least, i, length(found[i]) AS size, length(judged[i]) AS judged,
        sum(length(gaps[i]) + length(found[i])) OVER (PARTITION BY doc_id, rule ORDER BY i) AS stop
    FROM m, unnest(range(1, len(found) + 1)) AS t(i)),
s AS (
    SELECT doc_id, kind, base, rule, stop - size AS start, concat(kind, ':', CAST(stop - size AS VARCHAR), ':', CAST(stop AS VARCHAR)) AS span
    FROM e WHERE judged >= least),
g AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, rule) FILTER (base) AS of_base,
        string_agg(span, ',' ORDER BY start, rule) AS spans
    FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(of_base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


ORACLE = {
    "op1_block_matrix_neighbours": """
WITH v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
    FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM p)
WHERE rank <= 20
""",
    "op2_suffix_automaton_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
iw AS (
    SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS s
    FROM i, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
    SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
    FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p)),
m AS (SELECT dw.doc_id, dw.n, dw.p, iw.item FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
h AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit
    FROM m, unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
k AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)
""",
    "op8_line_run_dedup": r"""
WITH l AS (
    SELECT doc_id, p - 1 AS pos, s[p] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
        unnest(range(1, len(s) + 1)) AS t(p)),
n AS (
    SELECT *, row_number() OVER w AS i, lead(line) OVER w AS after, lead(pos) OVER w AS after_pos
    FROM l WHERE trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
two AS (
    SELECT doc_id, pos, after_pos, row_number() OVER (PARTITION BY line, after ORDER BY doc_id, pos) AS nth
    FROM n WHERE after IS NOT NULL),
one AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth
    FROM n WHERE len(regexp_split_to_array(trim(line), '\s+')) >= 50),
gone AS (
    SELECT doc_id, pos FROM two WHERE nth > 1 UNION SELECT doc_id, after_pos FROM two WHERE nth > 1
    UNION SELECT doc_id, pos FROM one WHERE nth > 1),
g AS (
    SELECT doc_id, count(*) AS n_removed, count(*) FILTER (starts) AS n_runs
    FROM (SELECT doc_id, pos - coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), -2) > 1 AS starts FROM gone)
    GROUP BY doc_id),
k AS (
    SELECT l.doc_id, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY l.pos) FILTER (gone.pos IS NULL) AS kept
    FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id)
SELECT k.doc_id, n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM k LEFT JOIN g USING (doc_id)
""",
    "op10_warc_index_merge": """
WITH p AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages),
k AS (SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
""",
    "op11_trie_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM w, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
    FROM c, unnest(range(1, len(w))) AS t(cut)
    JOIN f AS l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(w[1:cut], ' ')
    JOIN f AS r ON r.lang = c.lang AND r.k = len(w) - cut AND r.phrase = array_to_string(w[cut + 1:len(w)], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
    SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS a FROM c, unnest([1, 2]) AS t(i) WHERE k = 3 GROUP BY ALL)
SELECT * FROM (
    SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, best.a DESC, best.phrase) AS rank,
        best.phrase, best.a, l, r, n, CAST(score AS BIGINT) AS score
    FROM best JOIN totals USING (lang) LEFT JOIN around ON around.lang = best.lang AND around.phrase = best.phrase
    WHERE around.a IS NULL OR 100 * around.a < 50 * best.a)
WHERE rank <= 2000
""",
    "op12_trigram_secret_scan": _secrets(),
    "op13_partenum_spellings": r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda v: list_reduce(list_concat([v], range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents),
seen AS (SELECT run, hex(encode(id || ':' || run)) AS h, count(*) AS n FROM runs GROUP BY id, run),
hashed AS (
    SELECT run, n, xor(list_reduce(
        list_concat([4294967295], list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
    FROM seen, crc),
w AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
          FROM hashed)
    GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM w, unnest(range(1, length(word) + 1)) AS t(i)),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest WHERE a.word <> b.word
    UNION SELECT less.word, w.word, w.n FROM less JOIN w ON w.word = less.rest
    UNION SELECT w.word, less.word, less.n FROM less JOIN w ON w.word = less.rest),
best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS most, first(near ORDER BY near_n DESC, near) AS near FROM pairs GROUP BY word),
forms AS (
    SELECT w.word, CASE WHEN most >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN most >= 2 * n THEN most END AS form_n
    FROM w LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS at FROM forms
    UNION SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.at WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, chain.at AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN chain USING (word) JOIN forms AS last ON last.word = chain.at AND last.form IS NULL
""",
}
