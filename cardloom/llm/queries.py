"""One query per operator of this folder, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (exact_dedup, fingerprints, language_id, licenses, manifest, mixing, ngram_join, packing, secrets, spelling,
               token_counts, token_files, toxicity)
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op7_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


@query("op6_token_counts")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.length_histogram(documents(spark, folder)))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(documents(spark, folder))


@query("op10_source_mixing", """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM totals),
filling AS (
  SELECT *, row_number() OVER f AS place,
         (1.5 * sum(source_size) OVER () - 2.0 * coalesce(sum(source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW f AS (ORDER BY source_size / weight, source NULLS LAST)),
leveled AS (
  SELECT source, source_size, least(weight * (SELECT arg_min(level, place) FROM filling WHERE level * weight <= 2.0 * source_size),
                                    2.0 * source_size)::DOUBLE AS target FROM filling),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM leveled),
drawn AS (
  SELECT s.doc_id, s.size, h.*, floor(ratio)::BIGINT AS certain, ratio - floor(ratio) AS p,
         target - floor(ratio)::BIGINT * h.source_size AS quota,
         (('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, 'null') || ':10'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM sized s JOIN shares h ON s.source IS NOT DISTINCT FROM h.source),
ranked AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM drawn),
ordered AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id::VARCHAR, size) AS upto FROM ranked WHERE rank IS NOT NULL),
cut AS (
  SELECT *, upto <= quota AS inside FROM ordered),
reached AS (
  SELECT source, coalesce(sum(size) FILTER (inside), 0) AS reached FROM cut GROUP BY source),
closing AS (
  SELECT c.source, arg_min(c.doc_id, struct_pack(a := abs(quota - reached - size), b := rank)) AS closing
  FROM cut c JOIN reached r ON c.source IS NOT DISTINCT FROM r.source
  WHERE NOT inside AND abs(quota - reached - size) < abs(quota - reached) GROUP BY c.source),
picked AS (
  SELECT d.doc_id, d.size, d.source_size, d.target,
         d.certain + (CASE WHEN coalesce(c.inside, false) OR coalesce(d.doc_id = e.closing, false) THEN 1 ELSE 0 END) AS copies
  FROM ranked d LEFT JOIN cut c ON c.doc_id = d.doc_id LEFT JOIN closing e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, copies::BIGINT AS copies, (copies * size)::BIGINT AS taken FROM picked""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(documents(spark, folder))


@query("op9_token_files")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.written_and_read(documents(spark, folder))


@query("op4_ngram_jaccard_join", """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT x, min(y) AS least FROM reach GROUP BY x) r ON r.x = d.doc_id""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.components(documents(spark, folder))


@query("op2_document_fingerprints")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_and_next(documents(spark, folder))


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identified(documents(spark, folder))


def _license_sql() -> str:
    wordings = ", ".join("({}, '{}', '{}')".format(k, name, wording.replace("'", "''"))
                         for k, (name, wording) in enumerate(licenses.TEMPLATES))
    return f"""
WITH templates AS (
  SELECT template, license, list_filter(string_split(regexp_replace(lower(wording), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM (VALUES {wordings}) AS t(template, license, wording)),
template_grams AS (
  SELECT DISTINCT template, license, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM templates),
template_sizes AS (SELECT template, license, count(*) AS m FROM template_grams GROUP BY template, license),
texts AS (
  SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS text FROM documents),
lines AS (
  SELECT doc_id, 'line' AS part, unnest(range(len(string_split(text, chr(10))))) AS position, unnest(string_split(text, chr(10))) AS words FROM texts),
blocks AS (
  SELECT doc_id, 'paragraph' AS part, unnest(range(len(regexp_split_to_array(text, '\\n[ \\n]*\\n')))) AS position,
         unnest(regexp_split_to_array(text, '\\n[ \\n]*\\n')) AS words FROM texts),
parts AS (
  SELECT * FROM lines UNION ALL SELECT * FROM blocks WHERE contains(trim(words, ' ' || chr(10)), chr(10))),
worded AS (
  SELECT doc_id, part, position, list_filter(string_split(replace(words, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM parts),
grams AS (
  SELECT DISTINCT doc_id, part, position, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM worded),
sizes AS (SELECT doc_id, part, position, count(*) AS n FROM grams GROUP BY ALL),
shared AS (
  SELECT doc_id, part, position, template, license, count(*) AS c FROM grams JOIN template_grams USING (gram) GROUP BY ALL),
scored AS (
  SELECT doc_id, part, position, s.template, s.license, 2 * c / (n + m) AS dice
  FROM shared s JOIN sizes USING (doc_id, part, position) JOIN template_sizes t ON t.template = s.template)
SELECT doc_id, part, position::INT AS position, license, dice FROM scored WHERE dice >= {licenses.LEAST}
QUALIFY row_number() OVER (PARTITION BY doc_id, part, position ORDER BY dice DESC, license, template) = 1"""


@query("op1_license_scan", _license_sql())
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


@query("op3_secret_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(documents(spark, folder))


#: crc32 of a text in DuckDB: its UTF-8 bytes go through a table of 256 entries that is made by the rule for one byte.
_CRC_TABLE = """crc AS (SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))) AS v FROM range(256) r(i)))"""


def _crc_sql(text: str) -> str:
    digits = f"hex(encode({text}))"
    listed = f"list_transform(range(1, length({digits}), 2), lambda i: ('0x' || substr({digits}, i, 2))::BIGINT)"
    return f"xor(list_reduce([4294967295] || {listed}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _tree_sql(name: str, leaves: str, levels: int = 8) -> list[str]:
    """CTEs ``{name}0``.. of the levels over ``leaves`` (tree, pos, size, node), with what stands left and right of each node."""
    out = []
    for k in range(levels + 1):
        below = leaves if k == 0 else (
            f"SELECT tree, pos // 16 AS pos, (max(size) + 15) // 16 AS size, CASE WHEN max(size) = 1 THEN any_value(node) "
            f"ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node FROM {name}{k - 1} GROUP BY tree, pos // 16")
        run = "PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
        out.append(f"{name}{k} AS (SELECT *, coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before, "
                   f"coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM ({below}))")
    return out


def _fold_sql(name: str, rows: str, place: str, levels: int = 8) -> list[str]:
    """CTEs that carry ``folded`` and ``proof`` of ``rows`` up the levels of a tree."""
    out, last = [], rows
    for k in range(levels):
        out.append(f"{name}f{k} AS (SELECT r.* REPLACE (CASE WHEN x.size = 1 THEN folded ELSE sha256(x.before || folded || x.after) END AS folded, "
                   f"proof || x.before || x.after AS proof) FROM {last} r JOIN {name}{k} x ON x.tree IS NOT DISTINCT FROM r.{name}tree "
                   f"AND x.pos = r.{place} // {16 ** k})")
        last = f"{name}f{k}"
    return out


def _manifest_sql() -> str:
    def hashed(text: str) -> str:
        parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    ctes = [_CRC_TABLE, f"""leaves AS (
  SELECT doc_id, source AS tree, {hashed('text')} AS node, {_crc_sql("doc_id::VARCHAR")} % {manifest.TAMPERED} = 0 AS hit,
         {hashed("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS changed FROM documents, crc)""",
            "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS size FROM leaves)",
            *_tree_sql("n", "SELECT tree, pos, size, node FROM placed"),
            "tops AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS size, node, tree AS source FROM n8)",
            *_tree_sql("s", "SELECT tree, pos, size, node FROM tops"),
            """opened AS (SELECT p.doc_id, p.node AS leaf, t.node AS subroot, p.tree AS ntree, p.pos, 0 AS stree, t.pos AS place,
  CASE WHEN hit THEN changed ELSE p.node END AS folded, '' AS proof FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.tree)""",
            *_fold_sql("n", "opened", "pos"), *_fold_sql("s", "nf7", "place")]
    return "WITH " + ",\n".join(ctes) + """
SELECT doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.node AS verified
FROM sf7, (SELECT node FROM s8) r"""


@query("op12_merkle_manifest", _manifest_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.verified_rows(documents(spark, folder))


@query("op11_spelling_variants", f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '{spelling.LETTER}+')) AS run FROM documents),
lowered AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs WHERE length(run) >= {spelling.SHORTEST}),
hashed AS (SELECT run, {_crc_sql("id || ':' || run")} AS h FROM lowered, crc),
words AS (
  SELECT CASE WHEN h % {spelling.SLIPS} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
vocab AS (SELECT word, count(*) AS n FROM words WHERE length(word) >= {spelling.SHORTEST} GROUP BY word HAVING count(*) >= {spelling.FEWEST}),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM vocab, unnest(range(1, length(word) + 1)) u(i)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, v.word, v.n FROM cuts c JOIN vocab v ON v.word = c.cut
  UNION SELECT v.word, c.word, c.n FROM cuts c JOIN vocab v ON v.word = c.cut),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
known AS (
  SELECT v.word, CASE WHEN near_n >= {spelling.TIMES} * v.n THEN near END AS form, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= {spelling.TIMES} * v.n THEN near_n END AS form_n FROM vocab v LEFT JOIN best b ON b.word = v.word),
led(word, root) AS (
  SELECT word, word FROM known UNION ALL SELECT l.word, k.form FROM led l JOIN known k ON k.word = l.root WHERE k.form IS NOT NULL),
ends AS (SELECT l.word, l.root FROM led l JOIN known k ON k.word = l.root WHERE k.form IS NULL)
SELECT k.word, k.form, e.root, k.n, k.n_near, k.form_n FROM known k JOIN ends e ON e.word = k.word""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(spelling.slipped(spelling.runs(documents(spark, folder)))))


@query("op13_toxicity")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
