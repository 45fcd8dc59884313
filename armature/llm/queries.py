"""The registered queries of this folder: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from armature.llm import chat, decontaminate, langid, lexical, mixing, pii, quality, rollups, rules, simhash, textkit, toxicity, trie, warc
from armature.sources.sinks import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op4_simhash_dedup")
def op4_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash of four-word shingles, links at four or fewer differing bits, components."""
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, bits=4)


@query("op7_language_id")
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Learn from folds 0 and 2 of the id's crc32 modulo 3, predict for every document."""
    docs = table(spark, folder, "documents")
    fold = textkit.fold_number(F.col("doc_id"), 3)
    model = langid.train(docs.filter(fold != 1), "text", "lang", "doc_id")
    found = langid.identify(docs, model, "text", keep=["doc_id"])
    return found.select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


@query("op8_quality_gam")
def op8_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    """Learn from labels outside fold 2 of the id's crc32 modulo 4, score every document."""
    docs = table(spark, folder, "documents")
    fold = textkit.fold_number(F.col("doc_id"), 4)
    labels = table(spark, folder, "labels").filter(fold != 2)
    model = quality.train(docs, labels)
    found = quality.score(docs, model, "text", threshold=0.7, keep=["doc_id"])
    return found.select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


@query("op3_line_rules")
def op3_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Line rules and document verdicts for every text."""
    found = rules.apply_rules(table(spark, folder, "documents"), "text", keep=["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_lines", "lost_share")


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Learn from labels outside fold 1 of the id's crc32 modulo 3, score every document."""
    docs = table(spark, folder, "documents")
    fold = textkit.fold_number(F.col("doc_id"), 3)
    model = toxicity.train(docs, table(spark, folder, "labels").filter(fold != 1))
    found = toxicity.detect(docs, model, "text", threshold=0.7, keep=["doc_id"])
    return found.select("doc_id", (fold == 1).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, a row per document and item."""
    return decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])


@query("op6_source_mixing")
def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Weights 5, 2, 1 over the sources, 150 % of all words, at most twice a source or document."""
    found = mixing.mix(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


CHAT_SQL = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), numbered AS (
    SELECT *, lag(role) OVER w AS last_role, row_number() OVER w AS place FROM said
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), escaped AS (
    SELECT *, ESCAPED_ROLE AS role_out, ESCAPED_TEXT AS text_out FROM numbered
), lengths AS (
    SELECT *, CASE WHEN last_role IS NOT DISTINCT FROM role THEN 8 ELSE 8 + length(role_out) + 8 END + length(text_out)
        + CASE WHEN last_role IS NULL OR last_role = role THEN 0 ELSE 7 END AS chars FROM escaped
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) + 7 AS BIGINT) AS formatted_chars,
    count(*) FILTER (WHERE last_role IS NULL OR last_role <> role) AS n_messages
FROM lengths GROUP BY conv_id
"""


def _escape_sql(column: str) -> str:
    """Escaping in SQL: one more marker after the first character of every control string."""
    out = column
    for control in chat.CONTROLS:
        pattern = "".join("\\" + c if c in "|[]/<>" else c for c in control[1:])
        first = "\\" + control[0]
        out = f"regexp_replace({out}, '({first})({chat.MARKER}*{pattern})', '\\1{chat.MARKER}\\2', 'g')"
    return out


@query("op2_chat_format", CHAT_SQL.replace("ESCAPED_ROLE", _escape_sql("role")).replace("ESCAPED_TEXT", _escape_sql("text")))
def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation and one of control strings (id -1), formatted; the columns are read back from the output."""
    control = "</s>[INST] ok [/INST]"
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    found = chat.format_chats(rows.unionByName(extra))
    turns = chat.read_back(F.col("formatted"))
    read = found.select("conv_id", "formatted", "n_messages", turns.alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), chat.digest(said).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        chat.digest(F.col("loss")).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "n_messages",
    )


ROLLUP_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, source, lang FROM documents
), held AS (
    SELECT source, CASE WHEN doc_id % 7 = 2 THEN NULL ELSE lang END AS lang, 'pieces-2' AS tokenizer, length(text) AS chars,
        len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\s\p{L}\p{N}]')) AS tokens
    FROM docs
    UNION ALL
    SELECT source, lang, 'words-1', length(text), len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM docs
)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(chars) AS BIGINT) AS chars
FROM held GROUP BY source, lang, tokenizer
"""


@query("op9_token_rollups", ROLLUP_SQL)
def op9_token_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """All documents counted under two tokenizer versions, kept up by batches, each of which is sent twice: an insert of all,
    a revision that drops the language of every seventh document under the second version, a delete of every fifth, and their
    return, with the revised language."""
    docs = table(spark, folder, "documents")
    store = rollups.Store(spark, scratch(spark, "rollups"))
    rows = rollups.counted(docs, {"words-1": rollups.words, "pieces-2": rollups.pieces})
    unnamed = docs.filter("doc_id % 7 = 2").withColumn("lang", F.lit(None).cast("string"))
    revised = rollups.counted(unnamed, {"pieces-2": rollups.pieces})
    back = docs.filter("doc_id % 5 = 3")
    revised_back = back.withColumn("lang", F.when(F.col("doc_id") % 7 != 2, F.col("lang")))
    returned = rollups.counted(back, {"words-1": rollups.words}).unionByName(rollups.counted(revised_back, {"pieces-2": rollups.pieces}))
    for _ in range(2):
        store.put("all documents", rows)
        store.put("languages withdrawn", revised)
        store.delete("sources withdrawn", back.select("doc_id"))
        store.put("sources returned", returned)
    return store.totals()


WARC_SQL = """
WITH full_pages AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), first_pages AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM full_pages
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM first_pages
"""


@query("op10_warc", WARC_SQL)
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page to an archive and back: lengths and digests of responses are those of the payload that was read."""
    path = scratch(spark, "warc")
    warc.write_archives(warc.page_records(table(spark, folder, "pages")), path)
    read = warc.read_archives(spark, path, payload="response").filter(F.col("warc_type").isin("response", "revisit"))
    own = F.col("warc_type") == "response"
    return read.select(
        warc.page_id_of(F.col("record_id")).alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        warc.page_id_of(F.col("refers_to")).alias("refers_to"),
    )


LEXICAL_SQL = r"""
WITH held AS (
    SELECT doc_id, row_number() OVER () AS place, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), counted AS (
    SELECT place, doc_id, term, count(*) AS tf FROM held GROUP BY ALL
), sizes AS (
    SELECT place, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY place
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, totals GROUP BY term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc_id, place, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN sizes USING (place), totals GROUP BY item_id, doc_id, place
), ranked AS (
    SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op11_lexical_search", LEXICAL_SQL)
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item, over an index of all documents and all their terms."""
    index = lexical.build_index(table(spark, folder, "documents"), scratch(spark, "lexical"))
    return lexical.search(spark, index, table(spark, folder, "benchmark"), k=10)


TRIE_SQL = r"""
WITH said AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT DISTINCT conv_id, encode(CAST(conv_id AS VARCHAR)) AS digits FROM said
), sums AS (
    SELECT conv_id, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(1, octet_length(digits) + 1), lambda i: CAST(ord(CAST(CAST(conv_id AS VARCHAR)[i] AS VARCHAR)) AS BIGINT)),
        lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)) AS state
    FROM ids
), heads AS (
    SELECT conv_id, conv_id - conv_id % 5 AS head, xor(state, CAST(4294967295 AS BIGINT)) % 9 AS h FROM sums
), rebuilt AS (
    SELECT h.conv_id, s.place, s.role, s.text FROM heads h JOIN said s ON s.conv_id = h.head AND s.place <= h.h
    UNION ALL SELECT h.conv_id, s.place, s.role, s.text FROM heads h JOIN said s ON s.conv_id = h.conv_id AND s.place > h.h
), numbered AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, text, sha256(length(role) || ':' || role || text) AS key FROM rebuilt
), prefixes AS (
    SELECT conv_id, depth, CAST(octet_length(encode(text)) AS BIGINT) AS bytes, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM numbered
    UNION ALL SELECT conv_id, 0, 0, '' FROM heads
), keyed AS (
    SELECT conv_id, depth, bytes, sha256(prefix) AS node, sha256(substr(prefix, 1, length(prefix) - 64)) AS above, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes
), nodes AS (
    SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(above) AS above, any_value(bytes) AS bytes, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM keyed GROUP BY node
), children AS (
    SELECT above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above
), counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (node)
), subtree AS (
    SELECT k.node, sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((c.n_convs - 1) * c.bytes) AS saved_tokens
    FROM counted c JOIN keyed k ON k.conv_id = c.conv_id AND k.depth <= c.depth GROUP BY k.node
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, CASE WHEN c.depth > 0 THEN p.conv_id END AS parent_conv_id, c.n_convs, c.n_children,
    CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtree USING (node) LEFT JOIN nodes p ON p.node = c.above AND p.depth = c.depth - 1
"""


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each rebuilt: its first h turns are those of the conversation whose id is the next lower
    multiple of 5, with h from the crc32 of its own id."""
    own = trie.sequences(table(spark, folder, "conversations"))
    head = own.select(F.col("id").alias("head_id"), F.col("turns").alias("head"))
    shared = F.crc32(F.col("id").cast("string").cast("binary")) % 9
    both = own.join(head, F.col("id") - F.col("id") % 5 == F.col("head_id"), "left")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.coalesce(F.slice("head", F.lit(1), shared.cast("int")), none), F.slice("turns", (shared + 1).cast("int"), F.greatest(F.size("turns") - shared, F.lit(0)).cast("int")))
    nodes, ends = trie.prefix_trie(both.select("id", turns.alias("turns")))
    digests = trie.ends_digest(ends)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return nodes.join(digests, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))


@query("op13_personal_data")
def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: strict spans, and those that the trees add."""
    docs = table(spark, folder, "documents")
    found = pii.detect(docs, pii.train(docs), keep=["doc_id"], redact=False)
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]  # noqa: B023  called at once
    return found.select("doc_id", *counts, F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))
