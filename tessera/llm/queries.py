"""The corpus operators bound to the given tables: thin queries that derive
the contract's columns from the operators' results, and SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (chat, codes, credentials, decontam, exact, langid, packing, pii, sharding, simhash, spans,
                         toxicity, tries)
from tessera.sources.tables import read_table


def op1_pii(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in every whole document: counts, digest of the base spans,
    all spans and their scores."""
    found = pii.detect(read_table(spark, d, "documents"))
    of = lambda kinds: F.filter("pii", lambda s: s["kind"].isin(*kinds))
    said = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[F.size(of([k])).cast("bigint").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(said(of(pii.BASE)), 256).alias("base_sha256"), said(F.col("pii")).alias("spans"),
        F.size("pii").cast("bigint").alias("n_spans"),
        F.array_join(F.transform("pii", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"))


def op2_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark windows of 10 words found in every whole document through an
    FM-index per shard: hit words, items, and the merged removal spans (in words, end exclusive)."""
    leaks = decontam.find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))
    hit = F.aggregate("words", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return leaks.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
        F.array_join(F.transform("words", lambda s: F.concat_ws(":", s[0], s[1])), ",").alias("removal_spans"))


def op3_sentence_spans(spark: SparkSession, d: str) -> DataFrame:
    """All documents without the sentences covered by a later occurrence of a
    run of two consecutive sentences."""
    out = spans.remove_repeats(read_table(spark, d, "documents"))
    return out.select("doc_id", "n_sentences", "n_removed", F.array_join(
        F.transform("removed", lambda s: F.concat_ws(":", s[0], s[1])), ",").alias("removed"), "text")


def toxicity_labels(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Every whole document scored by a classifier chain: low quality, then
    toxic given the probability of low quality."""
    docs = read_table(spark, d, "documents")
    out = toxicity.score(docs, toxicity.train(docs, toxicity_labels(spark, d), ["low_quality", "toxic"]))
    return out.select("doc_id", "p_low_quality", "p_toxic", "is_low_quality", F.col("is_toxic").alias("toxic"))


#: Tool schemas the calls are checked against: field, type, required.
TOOLS = {"search": [("query", "string", True), ("limit", "integer", False)],
         "store": [("key", "string", True), ("value", "string", True), ("public", "boolean", False)]}


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Conversations in the schema of events: assistant turns as calls that
    follow the call two turns earlier, later user turns as results. Names,
    arguments and their faults vary with the text."""
    text, n = F.coalesce(F.col("text"), F.lit("")), F.length(F.coalesce(F.col("text"), F.lit("")))
    ident = lambda back: F.concat_ws("-", "conv_id", F.col("turn") - back)
    call, answer = F.col("role") == "assistant", (F.col("role") == "user") & (F.col("turn") > 0)
    name = F.when(n % 11 == 0, "other").when(n % 2 == 0, "search").otherwise("store")
    arguments = (F.when(n % 13 == 0, text)
                 .when(n % 7 == 0, F.to_json(F.struct(n.cast("string").alias("limit"), text.alias("query"))))
                 .when(n % 2 == 0, F.to_json(F.struct(text.alias("query"), n.alias("limit"))))
                 .when(n % 5 == 0, F.to_json(F.struct(text.alias("value"), F.lit(1).alias("public"))))
                 .otherwise(F.to_json(F.struct(text.alias("value"), (n % 3 == 0).alias("public"), ident(0).alias("key")))))
    return conversations.select(
        "conv_id", "turn", F.when(answer, "tool").otherwise(F.col("role")).alias("role"),
        F.when(~call | call.isNull(), F.col("text")).alias("text"),
        F.when(call, ident(0)).when(answer, ident(1)).alias("call_id"),
        F.when(call & (F.col("turn") >= 2), ident(2)).alias("after_id"),
        F.when(call, name).alias("name"), F.when(call, arguments).alias("arguments"))


def op5_tool_calls(spark: SparkSession, d: str) -> DataFrame:
    """Events of all conversations with tool calls linked to results, put in
    topological order, validated and written as canonical JSON."""
    events = conversation_events(read_table(spark, d, "conversations"))
    return chat.link_tool_calls(events, chat.tool_table(spark, TOOLS))


def op6_packing(spark: SparkSession, d: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens, windows
    filled with the BM25 neighbours of a seed document."""
    return packing.pack(read_table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_hilbert_shards(spark: SparkSession, d: str) -> DataFrame:
    """All documents ordered along a Hilbert curve through (lang, source, size)
    and cut into 24 runs whose row counts differ by at most one (law ``rows``)."""
    docs = read_table(spark, d, "documents")
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    size = F.octet_length(data).cast("bigint") + 8
    placed = sharding.hilbert_shards(
        docs, "doc_id",
        {"lang": F.col("lang"), "source": F.col("source"), "size": sharding.size_code(size)},
        {"size": size, "text_crc32": F.crc32(data)})
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"), "cell")


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    """Language of every whole text by segmentation-marginalised unigrams,
    learnt from documents whose crc32(doc_id) mod 3 is not 1."""
    docs = read_table(spark, d, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(3)) == 1, F.lit(False))
    model = langid.train(docs, ~held, public_tokenizers.path("byte_bpe_50k.json"))
    out = langid.identify(docs, model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, d: str) -> DataFrame:
    """SimHash fingerprints of all documents (3-word shingles) and the smallest
    doc_id reachable over links of at most 3 differing bits."""
    near = simhash.near_duplicates(read_table(spark, d, "documents"), shingle=3, max_bits=3)
    return near.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op10_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the row its exact copies keep (largest doc_id)."""
    return exact.exact_duplicates(read_table(spark, d, "documents"))


def op11_credentials(spark: SparkSession, d: str) -> DataFrame:
    """Secrets in every whole document: counts, digest of the base spans, all
    spans with the weak parts of multipart credentials, and the credentials."""
    found = credentials.detect(read_table(spark, d, "documents"))
    of = lambda kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    said = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[F.size(of([k])).cast("bigint").alias(f"n_{k}") for k in credentials.BASE],
        F.sha2(said(of(credentials.BASE)), 256).alias("base_sha256"), said(F.col("secrets")).alias("spans"),
        F.size("secrets").cast("bigint").alias("n_spans"), F.size("credentials").cast("bigint").alias("n_credentials"),
        F.array_join(F.transform("secrets", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"))


def op12_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    """Product codes of all valid embeddings (8 parts, 16 integer entries, 6
    rounds) by equal-average search."""
    coded, books = codes.compress(read_table(spark, d, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    """Every order of the five filters over all documents, per source."""
    labels = read_table(spark, d, "labels").select(
        "doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    return tries.audit(tries.masks(read_table(spark, d, "documents"), labels))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_sentence_spans": op3_sentence_spans,
    "op4_toxicity": op4_toxicity,
    "op5_tool_calls": op5_tool_calls,
    "op6_packing": op6_packing,
    "op7_hilbert_shards": op7_hilbert_shards,
    "op8_language_id": op8_language_id,
    "op9_simhash": op9_simhash,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_credentials": op11_credentials,
    "op12_vector_codes": op12_vector_codes,
    "op13_filter_audit": op13_filter_audit,
}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """All rounds as steps of one statement; the nearest entry is the least
    distance * entries + index."""
    near = """a{k} AS MATERIALIZED (SELECT x.id, x.p, any_value(x.pt) AS pt, min({n} * CAST(list_sum(
        [(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x.pt, b.pt)]) AS BIGINT) + b.e) AS d FROM x JOIN b{k} b ON b.p = x.p GROUP BY x.id, x.p)"""
    move = """s{k} AS (SELECT p, d % {n} AS e, i, sum(pt[i]) AS s, count(*) AS c FROM a{k}, unnest(range(1, len(pt) + 1)) t(i) GROUP BY p, d % {n}, i),
        b{j} AS MATERIALIZED (SELECT p, e, list(CAST((s - ((s % c) + c) % c) // c AS BIGINT) ORDER BY i) AS pt FROM s{k} GROUP BY p, e
            UNION ALL SELECT p, e, pt FROM b{k} b WHERE NOT EXISTS (SELECT 1 FROM s{k} s WHERE s.p = b.p AND s.e = b.e))"""
    steps = ",\n        ".join(x for k in range(rounds) for x in (near.format(k=k, n=entries), move.format(k=k, j=k + 1, n=entries)))
    return f"""WITH v AS (SELECT vec_id AS id, label, [TRY_CAST(floor(4096 * CAST(y AS DOUBLE)) AS BIGINT) FOR y IN embedding] AS c FROM embeddings
            WHERE embedding IS NOT NULL AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0),
        x AS MATERIALIZED (SELECT id, p, c[p * (len(c) // {parts}) + 1:(p + 1) * (len(c) // {parts})] AS pt FROM v, unnest(range({parts})) t(p)),
        b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY id) - 1 AS e, pt FROM x
            QUALIFY row_number() OVER (PARTITION BY p ORDER BY id) <= {entries}),
        {steps}, {near.format(k=rounds, n=entries)},
        r AS (SELECT id, string_agg(lpad(format('{{:x}}', d % {entries}), 2, '0'), '' ORDER BY p) AS code,
            CAST(sum(d // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY id),
        h AS (SELECT sha256(string_agg(array_to_string(pt, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
        SELECT v.id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM v JOIN r ON r.id = v.id, h"""


ORACLE: dict[str, str] = {
    "op2_decontamination": f"""WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        phrase AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
            FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0),
        d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
        found AS (SELECT o.doc_id, o.i, o.n, p.item_id FROM (
            SELECT d.doc_id, i, s.n, array_to_string(d.w[i:i + s.n - 1], ' ') AS g
            FROM d, (SELECT DISTINCT n FROM phrase) s, unnest(range(1, len(d.w) - s.n + 2)) t(i)) o JOIN phrase p ON p.g = o.g AND p.n = o.n),
        hit AS (SELECT DISTINCT doc_id, unnest(range(i - 1, i - 1 + n)) AS p FROM found),
        span AS (SELECT doc_id, min(p) AS a, max(p) + 1 AS z, count(*) AS n FROM (
            SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS island FROM hit) h GROUP BY doc_id, island),
        h AS (SELECT doc_id, sum(n) AS n_hit, string_agg(a || ':' || z, ',' ORDER BY a) AS spans FROM span GROUP BY doc_id),
        m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) f GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated, coalesce(spans, '') AS removal_spans
        FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id""",
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_vector_codes": _vector_codes_sql(),
    "op13_filter_audit": """WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
        f AS (SELECT doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
                100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
                coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM w),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
            FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
        letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letter a, letter b, letter c, letter d, letter e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        step AS (SELECT o AS filter_order, CAST(k AS INT) AS step, [strpos('ABCDE', y) FOR y IN string_split(o[:k - 1], '') IF y <> ''] AS before,
            strpos('ABCDE', o[k]) AS f, o[k] AS x FROM orders, unnest(range(1, 6)) t(k)),
        r AS (SELECT part, filter_order, step, x, m.fails[f] AS fail, len([b FOR b IN before IF m.fails[b]]) = 0 AS alive,
            len([b FOR b IN m.fails IF b]) = 1 AS sole, n, good, toxic FROM m, step),
        s AS (SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (WHERE alive AND NOT fail), 0) AS kept,
            coalesce(sum(n) FILTER (WHERE alive AND fail), 0) AS removed, coalesce(sum(n) FILTER (WHERE fail AND NOT alive), 0) AS redundant,
            coalesce(sum(n) FILTER (WHERE fail AND sole), 0) AS unique_fails,
            coalesce(sum(good) FILTER (WHERE alive AND fail), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE alive AND fail), 0) AS toxic_lost
            FROM r GROUP BY part, filter_order, step, x)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
            CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
            CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM s""",
}
