"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import bitslice, bpe, chat, decontam, infill, kmeans, langid, lmscore, mil, revisit, simhash, skipchain, templates
from logweir.llm.common import held_out, table

#: From this score on a document counts as toxic.
TOXIC = 0.7
VOCABULARY = "byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id of its near-duplicate component."""
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words in benchmark windows and the items it shares them with."""
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"),
    )


WORDS = r"""regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES["op6_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format('text')} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 13) AS m FROM (SELECT item_id, {WORDS.format('text')} AS w FROM benchmark) WHERE len(w) > 0),
spans AS (SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS span FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS s FROM i)),
places AS (SELECT r, m, s, array_to_string(w[s:s + m - 1], ' ') AS span
           FROM (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM spans) WHERE len(w) >= m)),
found AS (SELECT r, p.m, s, item_id FROM places p JOIN spans USING (m, span)),
hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS x FROM (SELECT DISTINCT r, s, m FROM found)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item_id::varchar AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of tokens, and digests of its ids and of the bytes they decode to."""
    import public_tokenizers

    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by cross-parsing entropy."""
    documents = table(spark, sf_dir, "documents")
    found = langid.identify(documents, langid.learn(documents))
    return found.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score")


@query
def op8_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity from its sentences, by weights learned from document labels."""
    documents = table(spark, sf_dir, "documents")
    model = mil.train(documents, table(spark, sf_dir, "labels"))
    found = mil.score(documents, model)
    return found.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
        F.size("sentences").cast("long").alias("n_sentences"),
    )


@query
def op9_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases, and the labels of the templates that it holds."""
    found = templates.scan(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])

    def labels(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    covered = F.size(F.array_distinct(F.flatten(F.transform("matches", lambda m: F.sequence(m["start"], m["end"] - 1)))))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        # The share of the words that stand in some match.
        F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(0.0).alias("score"),
    )


@query
def op4_pii_skipchain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: base spans counted and digested, and all spans listed."""
    documents = table(spark, sf_dir, "documents")
    found = skipchain.find(documents, skipchain.train(documents))
    base = F.filter("spans", lambda s: s["base"])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"), *[count(k) for k in skipchain.KINDS], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


@query
def op1_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth embedding by integer inner product."""
    vectors = table(spark, sf_dir, "embeddings")
    return bitslice.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


ORACLES["op1_bitsliced_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::double[], c.e::double[])::bigint AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank::integer AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cross-entropy difference between documents of good quality and all documents."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lmscore.score(table(spark, sf_dir, "documents"), good).withColumnRenamed("id", "doc_id")


def captures(pages: DataFrame) -> DataFrame:
    """``pages`` seen as captures under their whole urls: up to two full responses, a revisit and a later response each.

    A revisit spells its url in another way: with www. and in capitals, with tracking and a fragment, with parameters in
    another order, or with a port and a final slash.  Validators follow from the url; now and then they change or are missing.
    """
    page = F.col("page_id")
    split = pages.select(
        page, "url", "html", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("kind"), F.regexp_replace("url", "#.*$", "").alias("base"), F.md5("url").alias("stamp")
    ).where(
        F.when(F.col("kind") == 0, page % 13 != 12).when(F.col("kind") == 1, page % 6 == 1).when(F.col("kind") == 2, page % 3 != 0).otherwise(page % 2 == 0)
    )
    revisit_, ident = F.col("kind") == 2, page * 4 + F.col("kind")
    more = F.when(F.contains("base", F.lit("?")), "&").otherwise("?")
    spelled = (
        F.when(page % 5 == 1, F.concat(F.lit("HTTP://WWW."), F.upper(F.regexp_extract("base", r"://(?:www\.)?([^/?]*)", 1)), F.regexp_extract("base", r"://[^/?]*(.*)$", 1)))
        .when(page % 5 == 2, F.concat("base", more, F.lit("utm_medium=mail#bottom")))
        .when(page % 5 == 3, F.concat("base", more, F.lit("a=1&b=2")))
        .when(page % 5 == 4, F.concat(F.regexp_replace("base", "^(https?://[^/?]+)", "$1:80"), F.when(more == "?", "/").otherwise("&")))
        .otherwise(F.col("url"))
    )
    stored = F.when(page % 5 == 3, F.concat("base", more, F.lit("b=2&a=1"))).otherwise(F.col("url"))
    tag = F.substring("stamp", 1, 8)
    body = F.when(F.col("kind") == 0, F.col("html")).when(~revisit_, F.concat(F.lit("changed "), ident.cast("string")))
    return split.select(
        ident.alias("id"),
        F.when(revisit_, spelled).otherwise(stored).alias("url"),
        ident.alias("time"),
        F.when(revisit_, 304).otherwise(200).alias("status"),
        F.when(revisit_ & (page % 11 == 0), F.substring("stamp", 17, 8)).when(page % 4 != 0, tag).alias("etag"),
        F.when(page % 7 != 0, F.substring("stamp", 9, 8)).alias("last_modified"),
        F.create_map(F.lit("Content-Length"), F.coalesce(F.length(body), F.lit(0)).cast("string"), F.lit("Date"), ident.cast("string"), F.lit("ETag"), F.coalesce(tag, F.lit(""))).alias("headers"),
        body.alias("body"),
    )


@query
def op3_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every not-modified capture with the response it stands for, the merged headers and a digest of the body."""
    found = revisit.resolve(captures(table(spark, sf_dir, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.select("id", "canonical", "time", "source_id", "outcome", F.array_join(entries, ";").alias("headers"), F.sha2("body", 256).alias("body_sha256"))


ORACLES["op3_revisit_resolution"] = r"""
WITH p AS (SELECT page_id AS p, url, html, unnest(range(0, 4)) AS kind, regexp_replace(url, '#.*$', '') AS base, md5(url) AS stamp FROM pages),
c AS (SELECT p, 4 * p + kind AS id, kind = 2 AS revisit, stamp, CASE kind WHEN 0 THEN html WHEN 2 THEN NULL ELSE 'changed ' || (4 * p + kind) END AS body,
             CASE WHEN contains(base, '?') THEN '&' ELSE '?' END AS more, base, url
      FROM p WHERE CASE kind WHEN 0 THEN p % 13 <> 12 WHEN 1 THEN p % 6 = 1 WHEN 2 THEN p % 3 <> 0 ELSE p % 2 = 0 END),
s AS (SELECT *, CASE WHEN revisit AND p % 5 = 1 THEN 'HTTP://WWW.' || upper(regexp_extract(base, '://(?:www\.)?([^/?]*)', 1)) || regexp_extract(base, '://[^/?]*(.*)$', 1)
                     WHEN revisit AND p % 5 = 2 THEN base || more || 'utm_medium=mail#bottom'
                     WHEN p % 5 = 3 THEN base || more || CASE WHEN revisit THEN 'a=1&b=2' ELSE 'b=2&a=1' END
                     WHEN revisit AND p % 5 = 4 THEN regexp_replace(base, '^(https?://[^/?]+)', '\1:80') || CASE WHEN more = '?' THEN '/' ELSE '&' END
                     ELSE url END AS asked,
             CASE WHEN revisit AND p % 11 = 0 THEN substr(stamp, 17, 8) WHEN p % 4 <> 0 THEN substr(stamp, 1, 8) END AS etag,
             CASE WHEN p % 7 <> 0 THEN substr(stamp, 9, 8) END AS modified FROM c),
b AS (SELECT *, regexp_replace(regexp_replace(trim(asked), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM s),
q AS (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
                    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid|ref)='))), '&') AS asking FROM b),
r AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\d*\.', ''), ':(80|443)$', '')
                || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') || CASE WHEN asking <> '' THEN '?' || asking ELSE '' END AS canonical FROM q),
m AS (SELECT v.id, max(f.id) AS source FROM r v LEFT JOIN r f ON v.canonical = f.canonical AND NOT f.revisit AND f.id < v.id WHERE v.revisit GROUP BY v.id),
o AS (SELECT v.id, v.canonical, v.stamp, f.id AS source_id, f.body,
             CASE WHEN v.canonical IS NULL THEN 'unusable' WHEN f.id IS NULL THEN 'unmatched'
                  WHEN coalesce(v.etag = f.etag, true) AND coalesce(v.modified = f.modified, true) THEN 'resolved' ELSE 'mismatch' END AS outcome
      FROM m JOIN r v ON v.id = m.id LEFT JOIN r f ON f.id = m.source)
SELECT id, canonical, id AS time, source_id, outcome,
       CASE WHEN outcome = 'resolved' THEN 'content-length=' || length(body) || ';date=' || id || ';etag=' || substr(stamp, 1, 8) END AS headers,
       CASE WHEN outcome = 'resolved' THEN sha256(body) END AS body_sha256
FROM o
"""


@query
def op11_drift_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster and distance after three rounds from 16 centroids."""
    found, centroids = kmeans.cluster(table(spark, sf_dir, "embeddings"))
    return kmeans.with_inertia(found, centroids).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _rounds(count: int) -> str:
    """Assignments a0 to a<count> and centroids c0 to c<count> as common tables."""
    steps = []
    for i in range(count + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT r, vec_id, arg_min(c, key) AS c, min(key)[1] AS distance FROM (
  SELECT r, vec_id, c, [d, c] AS key FROM (
    SELECT r, vec_id, c, list_sum(list_transform(list_zip(v.e, c{i}.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint AS d FROM v, c{i})) GROUP BY r, vec_id)""")
        if i < count:
            steps.append(f"""
s{i} AS (SELECT c, place, sum(x)::hugeint AS s, count(*)::hugeint AS n FROM (SELECT c, unnest(range(1, 65)) AS place, unnest(e) AS x FROM a{i} JOIN v USING (r)) GROUP BY c, place),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m, e) AS e FROM c{i} LEFT JOIN
  (SELECT c, list(((s - ((s % n) + n) % n) // n)::bigint ORDER BY place) AS m FROM s{i} GROUP BY c) USING (c))""")
    return ",".join(steps)


ORACLES["op11_drift_clustering"] = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS c, e FROM
  (SELECT e, sha256('1:' || vec_id) AS h FROM v ORDER BY h NULLS LAST, e LIMIT 16)),{_rounds(kmeans.ROUNDS)}
SELECT vec_id, c::integer AS cluster, distance, sum(distance) OVER (PARTITION BY c)::bigint AS cluster_inertia,
       sum(distance) OVER ()::bigint AS inertia, sha256(array_to_string(e, ',')) AS centroid_sha256
FROM a{kmeans.ROUNDS} JOIN c{kmeans.ROUNDS} USING (c)
"""


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's form, the lengths of its pieces, and digests of the output and of the text rebuilt from it."""
    found = infill.transform(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLES["op12_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::varchar, '')) AS h FROM documents),
w AS (SELECT *, CASE WHEN t = '' THEN [] ELSE regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') END AS w,
             list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::bigint) AS x FROM d),
p AS (SELECT *, len(w) AS n, least(x[1] % (len(w) + 1), x[2] % (len(w) + 1)) AS a, greatest(x[1] % (len(w) + 1), x[2] % (len(w) + 1)) AS b FROM w),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR x[3] % 100 >= 50 THEN 'plain'
                     WHEN x[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM p)
SELECT doc_id, n::bigint AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::bigint AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::bigint AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM f
"""

#: A conversation whose texts hold the marks of a common template.
CLASHING = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))


@query
def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation folded from its event log, formatted, and read back from the formatted text."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    clashing = spark.createDataFrame(list(CLASHING), "conv_id long, turn long, role string, text string")
    log = chat.logged(told.unionByName(clashing))
    rendered = chat.render(chat.reconstruct(log)).select("conv_id", "segments", chat.formatted(F.col("segments")).alias("formatted"))
    read = rendered.select("conv_id", "formatted", chat.turns(F.col("formatted")).alias("turns"), chat.trained(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op13_chat_formatting"] = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, regexp_replace(role, '([<\[])(~*)({chat.CONTROLS})', '\1~\2\3', 'g') AS r, regexp_replace(text, '([<\[])(~*)({chat.CONTROLS})', '\1~\2\3', 'g') AS t FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(r) + length(t) + length('<|turn|><|text|><|end|>'))::bigint AS formatted_chars
FROM e GROUP BY conv_id
"""
