"""The operators over the given tables: one query each, with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from spokewise.llm import decontaminate, exact_dedup, filter_audit, html, language, merkle, mixing, near_dup, quality, templates, token_counts, token_files, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NORMAL = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"), use=~quality.held_out())
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query(
    "op2_exact_dedup",
    f"""WITH d AS (SELECT doc_id, sha256({NORMAL}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
)
def exact_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, folder, "documents"))


CAPTURES = r"""plain AS (SELECT page_id, url, coalesce(html, '') AS html, regexp_replace(trim(url), '#.*$', '') AS p FROM pages),
parts AS (SELECT *, regexp_matches(p, '^[A-Za-z][A-Za-z0-9+.-]*://') AS has_scheme,
    regexp_replace(regexp_replace(lower(regexp_extract(p, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(p, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(p, '\?(.*)$', 1), '&'), lambda x: x <> ''
      AND NOT starts_with(lower(regexp_extract(x, '^([^=]*)', 1)), 'utm_')
      AND lower(regexp_extract(x, '^([^=]*)', 1)) NOT IN ('fbclid', 'gclid', 'ref'))), '&') AS q FROM plain),
base AS (SELECT page_id AS n, url, CASE WHEN has_scheme THEN host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END ELSE p END AS k,
    1600000000 + page_id * 41 % 5000011 AS t, '"' || md5(html) || '"' AS tag, '"' || md5(html || '+') || '"' AS other, length(html) AS size FROM parts),
responses AS (SELECT n * 4 AS id, k, t AS ts, tag AS etag, t - 60 AS modified, size FROM base
  UNION SELECT n * 4 + 3, k, t + 864000, other, t + 864000 - 60, size FROM base WHERE n % 3 = 0),
visits AS (SELECT n * 4 + 1 AS id, url, k, t + (n % 9 - 2) * 86400 AS ts, CASE WHEN n % 5 = 0 THEN other ELSE 'W/' || tag END AS etag,
    CAST(NULL AS BIGINT) AS modified FROM base
  UNION ALL SELECT n * 4 + 2, url, k, t + 2592000, NULL, CASE WHEN n % 3 = 0 THEN t + 864000 ELSE t END - 60 FROM base),
revisits AS (SELECT *, row_number() OVER () AS visit FROM visits),
joined AS (SELECT v.*, r.id AS rid, r.etag AS r_etag, r.modified AS r_modified, r.size AS r_size,
    row_number() OVER (PARTITION BY v.visit ORDER BY r.ts DESC, r.id DESC) AS place
  FROM revisits v LEFT JOIN responses r ON v.k = r.k AND r.ts < v.ts),
judged AS (SELECT *, CASE WHEN rid IS NULL THEN 'orphan' WHEN etag IS NOT NULL
    THEN CASE WHEN replace(etag, 'W/', '') = r_etag THEN 'resolved' ELSE 'changed' END
    WHEN modified = r_modified THEN 'resolved' ELSE 'changed' END AS status FROM joined WHERE place = 1)"""


@query(
    "op3_warc_revisits",
    f"""WITH {CAPTURES}
SELECT id AS record_id, url, ts AS captured, rid AS response_id, status,
  CASE WHEN status = 'resolved' THEN
    CASE WHEN etag IS NOT NULL THEN 'cache-control: max-age=60' || chr(10) ELSE '' END
    || 'content-length: ' || r_size || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10)
    || 'etag: ' || coalesce(etag, r_etag) || chr(10) || 'last-modified: ' || coalesce(modified, r_modified) || chr(10) || 'server: archive'
  END AS headers
FROM judged""",
)
def warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve_revisits(warc.captures_of_pages(table(spark, folder, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda h: F.concat(h["key"], F.lit(": "), h["value"]))
    return found.withColumn("headers", F.array_join(F.array_sort(lines), "\n"))


@query(
    "op4_line_templates",
    rf"""WITH
d AS (SELECT doc_id, row_number() OVER () AS row, text, string_split(text, chr(10)) AS raw FROM documents),
l AS (SELECT doc_id, row, k, raw[k] AS line, regexp_replace(trim(raw[k]), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m
  FROM (SELECT *, unnest(range(1, len(raw) + 1)) AS k FROM d)),
p AS (SELECT *, string_split(m, ' ') AS t FROM l WHERE len(string_split(m, ' ')) >= 4),
u AS (SELECT DISTINCT row, m, t, len(t) || ' ' || array_to_string(t[1:2], ' ') AS leaf FROM p),
o AS (SELECT leaf FROM u GROUP BY 1 HAVING count(DISTINCT row) >= 10),
w AS (SELECT leaf, m, t, count(*) AS weight FROM u SEMI JOIN o USING (leaf) GROUP BY 1, 2, 3),
z AS (SELECT leaf, sum(weight) AS size FROM w GROUP BY 1),
x AS (SELECT leaf, m, weight, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS place FROM w),
c AS (SELECT leaf, place, token FROM x JOIN z USING (leaf) GROUP BY 1, 2, 3
  HAVING sum(weight) >= 10 AND sum(weight) >= 0.05 * max(size) AND token <> '<*>'),
g AS (SELECT x.leaf, m, array_to_string(list(CASE WHEN c.token IS NULL THEN '<*>' ELSE x.token END ORDER BY place), ' ') AS template,
    count(c.token) AS fixed, count(*) AS n FROM x LEFT JOIN c USING (leaf, place, token) GROUP BY 1, 2),
h AS (SELECT m, template FROM g WHERE fixed >= 0.5 * n),
r AS (SELECT template FROM h JOIN u USING (m) GROUP BY 1 HAVING count(DISTINCT row) >= 10),
gone AS (SELECT m FROM h SEMI JOIN r USING (template)),
f AS (SELECT row, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(gone.m) AS n_dropped,
    array_to_string(list(line ORDER BY k) FILTER (WHERE gone.m IS NULL), chr(10)) AS kept
  FROM l LEFT JOIN gone ON gone.m = l.m AND len(string_split(l.m, ' ')) >= 4 GROUP BY 1)
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(kept, '')) AS text_sha256 FROM f""",
)
def line_templates(spark: SparkSession, folder: str) -> DataFrame:
    found = templates.drop_recurring_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query(
    "op5_near_dedup",
    rf"""WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all({NORMAL}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
    ELSE array_to_string(ws[k : k + 4], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS k FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, top) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.top FROM r JOIN e ON e.a = r.doc_id),
t AS (SELECT doc_id, min(top) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM t LEFT JOIN n USING (doc_id)""",
)
def near_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"))


@query("op6_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html.extract(table(spark, folder, "pages"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query(
    "op7_decontamination",
    rf"""WITH
d AS (SELECT doc_id, regexp_extract_all({NORMAL}, '{PLAIN}') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({NORMAL}, '{PLAIN}') AS ws FROM benchmark),
bw AS (SELECT item, least(len(ws), 13) AS m, array_to_string(ws[k : k + least(len(ws), 13) - 1], ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 11, 2))) AS k FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, k, m, array_to_string(ws[k : k + m - 1], ' ') AS win
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM bw) WHERE len(ws) >= m)),
hit AS (SELECT DISTINCT doc_id, k, m, item FROM dw JOIN bw USING (m, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS names FROM hit GROUP BY 1)
SELECT doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, bench = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontaminate.matched(docs, bench, keep=["doc_id"])
    items = F.array_sort(F.array_distinct(F.filter(F.transform("__matches", lambda m: m["item"]), lambda i: i.isNotNull())))
    found = found.select("doc_id", F.col("__n_words").alias("n_words"), decontaminate.hit_words(F.col("__matches")).alias("n_hit"), items.alias("items"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


@query("op8_token_counts")
def token_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), token_counts.read_pieces(), ["doc_id"])


@query("op9_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    model = language.fit(table(spark, folder, "documents"))
    return language.identify(table(spark, folder, "pages"), model)


@query(
    "op10_mixing",
    r"""WITH
d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS mark,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
k AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, [5, 2, 1][CAST(rank % 3 + 1 AS INT)] AS weight, 3 * source_size AS most FROM k),
v AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights,
    CAST(coalesce(sum(most) OVER o, 0) AS BIGINT) AS full_before, CAST(coalesce(sum(weight) OVER o, 0) AS BIGINT) AS weight_before,
    row_number() OVER (ORDER BY most / weight, rank) AS place
  FROM w WINDOW o AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - full_before) / (weights - weight_before) AS level FROM v),
f AS (SELECT place AS first_place, level AS first_level FROM l WHERE level * weight <= most ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN place >= first_place THEN first_level * weight ELSE CAST(most AS DOUBLE) END AS target FROM l, f),
c AS (SELECT d.*, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS wanted,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY mark, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS epochs FROM c)
SELECT doc_id, source, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, wanted - epochs * source_size - start)) AS BIGINT) AS taken FROM e""",
)
def mixing_query(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(table(spark, folder, "documents")).drop("positions")


@query(
    "op11_filter_audit",
    r"""WITH
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (SELECT doc_id, part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
    100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e FROM d),
g AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY 1),
t AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
    || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed,
    count(*) AS n, count_if(coalesce(good, false)) AS good, count_if(coalesce(toxic, false)) AS toxic
  FROM f LEFT JOIN g USING (doc_id) GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM l p, l q, l r, l s, l u
  WHERE p.x NOT IN (q.x, r.x, s.x, u.x) AND q.x NOT IN (r.x, s.x, u.x) AND r.x NOT IN (s.x, u.x) AND s.x <> u.x),
k AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
v AS (SELECT t.*, k.*, contains(failed, own) AS fails, failed <> '' AND translate(failed, earlier, '') <> failed AS gone FROM t, k),
w AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
    CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (WHERE failed = own), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
  FROM v GROUP BY part, filter_order, step, own)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM w""",
)
def filter_audit_query(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op12_token_files")
def token_files_query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(table(spark, folder, "documents"), path, separator="<|endoftext|>")


def _field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || {name}, '-')"


_FIELDS = " || ".join(_field(n) for n in ("doc_id", "source", "lang", "n_chars"))


@query(
    "op13_merkle_manifest",
    rf"""WITH RECURSIVE
crc AS (SELECT DISTINCT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, k: xor(a >> 1, (a & 1) * 3988292384))), 4294967295) AS crc FROM documents),
d AS (SELECT doc_id, source, sha256({_FIELDS} || {_field('text')}) AS leaf,
    sha256({_FIELDS} || {_field("replace(text, chr(10), '')")}) AS other, coalesce(crc % 2 = 0, false) AS hit FROM documents LEFT JOIN crc USING (doc_id)),
l AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS row FROM d),
s(tree, level, place, digest, n) AS (SELECT tree, 0, place, leaf, n FROM l
  UNION ALL SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3 FROM s WHERE n > 1 GROUP BY tree, level, place // 3, n),
r AS (SELECT tree, digest FROM s WHERE n = 1),
u(level, place, digest, n) AS (SELECT 0, tree, digest, (SELECT count(*) FROM r) FROM r
  UNION ALL SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY level, place // 3, n),
runs AS (SELECT tree, level, place // 3 AS run, list(digest ORDER BY place) AS ds FROM s WHERE n > 1 GROUP BY 1, 2, 3),
tops AS (SELECT level, place // 3 AS run, list(digest ORDER BY place) AS ds FROM u WHERE n > 1 GROUP BY 1, 2),
f(row, tree, level, place, digest, proof) AS (SELECT row, tree, 0, place, CASE WHEN hit THEN other ELSE leaf END, '' FROM l
  UNION ALL SELECT row, f.tree, f.level + 1, place // 3, sha256(array_to_string(ds[1:place % 3], '') || digest || array_to_string(ds[place % 3 + 2:], '')),
    proof || array_to_string(ds[1:place % 3], '') || array_to_string(ds[place % 3 + 2:], '')
  FROM f JOIN runs ON runs.tree = f.tree AND runs.level = f.level AND runs.run = f.place // 3),
g AS (SELECT row, tree, digest, proof FROM f QUALIFY level = max(level) OVER (PARTITION BY row)),
h(row, level, place, digest, proof) AS (SELECT row, 0, tree, digest, proof FROM g
  UNION ALL SELECT row, h.level + 1, place // 3, sha256(array_to_string(ds[1:place % 3], '') || digest || array_to_string(ds[place % 3 + 2:], '')),
    proof || array_to_string(ds[1:place % 3], '') || array_to_string(ds[place % 3 + 2:], '')
  FROM h JOIN tops ON tops.level = h.level AND tops.run = h.place // 3),
e AS (SELECT row, digest, proof FROM h QUALIFY level = max(level) OVER (PARTITION BY row)),
top AS (SELECT digest FROM u WHERE n = 1)
SELECT doc_id, leaf, r.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256, e.digest AS folded_root, e.digest = top.digest AS verified
FROM l JOIN r USING (tree) JOIN e USING (row), top""",
)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tampered_manifest(table(spark, folder, "documents"))
