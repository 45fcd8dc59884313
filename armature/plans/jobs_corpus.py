"""Instruction-corpus and batch-plan jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from armature.operators import batching as B
from armature.operators import corpus as C
from armature.operators.smallside import cut_lineage
from armature.plans import views as W
from armature.plans.jobs_tokens import SPACE, strip_sql
from armature.plans.registry import job
from armature.sources import tables


@job(
    "reformat_qa_to_chat",
    W.sql(
        "v_qa",
        f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN CAST(image_id AS VARCHAR) ELSE 'c' || CAST(image_id AS VARCHAR) || '.v1' END AS id,
        CASE WHEN doc_id % 2 = 0 THEN 'vg/' || CAST(image_id AS VARCHAR) || '.jpg' ELSE 'chart/c' || CAST(image_id AS VARCHAR) || '.v1.png' END AS image,
        '<image>' || chr(10) || {strip_sql('question')} AS human, {strip_sql('answer')} AS gpt FROM v_qa""",
    ),
)
def reformat_qa_to_chat(spark, d):
    rows = W.qa(spark, d)
    named = F.concat(F.lit("c"), F.col("image_id").cast("string"), F.lit(".v1.png"))
    even = F.col("doc_id") % 2 == 0
    plain = C.qa_to_chat(rows.filter(even), F.col("image_id"), "vg", keep=["doc_id"])
    charts = C.qa_to_chat(rows.filter(~even), named, "chart", True, keep=["doc_id"])
    said = lambda i: F.col("conversations")[i]["value"]
    return C.merge_corpora(plain, charts).select("doc_id", "id", "image", said(0).alias("human"), said(1).alias("gpt"))


@job(
    "verify_images_exist",
    W.sql("v_qa", "SELECT image_id, count(*) AS n_references FROM v_qa WHERE image_id NOT IN (SELECT page_id FROM pages) GROUP BY 1"),
)
def verify_images_exist(spark, d):
    return C.missing_images(W.qa(spark, d), "image_id", tables.table(spark, d, "pages"), "page_id")


@job(
    "merge_corpora",
    """SELECT doc_id AS id, lang, CAST(n_chars AS DOUBLE) AS n_chars, NULL::VARCHAR AS image FROM documents
    UNION ALL SELECT doc_id, lang, NULL, concat(CAST(doc_id AS VARCHAR), '.jpg') FROM documents SEMI JOIN labels USING (doc_id)""",
)
def merge_corpora(spark, d):
    docs = tables.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", F.col("n_chars").cast("double").alias("n_chars"))
    labeled = docs.join(tables.table(spark, d, "labels").select(F.col("doc_id").alias("id")), "id", "left_semi")
    visual = labeled.select("id", "lang", F.concat(F.col("id").cast("string"), F.lit(".jpg")).alias("image"))
    return C.merge_corpora(docs, visual)


@job(
    "shuffle_corpus",
    " UNION ALL ".join(f"SELECT {o} AS output, doc_id, row_number() OVER (ORDER BY {W.draw(7, str(o), 'doc_id')}, doc_id) - 1 AS position FROM documents" for o in range(2)),
)
def shuffle_corpus(spark, d):
    docs = tables.table(spark, d, "documents").select("doc_id")
    one = lambda o: C.shuffle_corpus(docs, ["doc_id"], 7, o).select(F.lit(o).alias("output"), "doc_id", "position")
    return one(0).unionByName(one(1))


def words_sql(s: str) -> str:
    return f"len(regexp_extract_all({s}, '[^{SPACE}]+'))"


@job(
    "modality_lengths",
    W.sql(
        "v_turns",
        f"""SELECT conv_id, image IS NOT NULL AS is_multimodal, CAST(sum({words_sql("replace(text, '<image>', '')")}) + CASE WHEN image IS NOT NULL THEN 576 ELSE 0 END AS BIGINT) AS align_length,
        CAST(sum({words_sql('text')}) AS BIGINT) AS finetune_length FROM v_turns GROUP BY conv_id, image""",
    ),
)
def modality_lengths(spark, d):
    return C.modality_lengths(W.turns(spark, d), "conv_id", 576)


FILE_NAME = "concat('img/', CAST(page_id // 2 AS VARCHAR), CASE page_id % 5 WHEN 0 THEN '.jpg' WHEN 1 THEN '.png' WHEN 2 THEN '.gif' WHEN 3 THEN '.jpeg' ELSE '.bmp' END)"


@job(
    "image_format_manifest",
    """WITH f AS (SELECT page_id, {n} AS name, concat('', CAST(page_id // 2 AS VARCHAR)) AS stem, page_id % 5 AS kind FROM pages)
    SELECT page_id, name, CASE WHEN kind IN (0, 3) THEN 'keep' WHEN stem IN (SELECT stem FROM f WHERE kind = 0) THEN 'skip'
      WHEN kind = 2 THEN 'convert first frame' WHEN kind = 1 THEN 'convert' ELSE 'error' END AS action FROM f""".format(n=FILE_NAME),
)
def image_format_manifest(spark, d):
    kind = F.col("page_id") % 5
    suffix = F.when(kind == 0, ".jpg").when(kind == 1, ".png").when(kind == 2, ".gif").when(kind == 3, ".jpeg").otherwise(".bmp")
    name = F.concat(F.lit("img/"), F.floor(F.col("page_id") / 2).cast("string"), suffix)
    files = tables.table(spark, d, "pages").select("page_id", name.alias("name"))
    return C.image_format_plan(files, "name").select("page_id", "name", "action")


# Batch plans ----------------------------------------------------------------------------------------------------------

SIZE, REPLICAS, SEED = 32, 4, 13
PLAN = {
    "shuffled": f"""SELECT *, row_number() OVER (PARTITION BY is_multimodal ORDER BY {W.draw(SEED, 'is_multimodal', 'example_id')}, example_id) - 1 AS seat,
      count(*) OVER (PARTITION BY is_multimodal) AS n FROM v_examples""",
    "full_": f"""SELECT example_id, is_multimodal, n_words, seat FROM shuffled
      UNION ALL SELECT example_id, is_multimodal, n_words, seat + n FROM shuffled WHERE seat < ((-n) % {SIZE} + {SIZE}) % {SIZE}""",
    "plan": f"""SELECT *, CAST(row_number() OVER (PARTITION BY is_multimodal, batch_no ORDER BY n_words DESC, seat) - 1 AS INT) AS slot
      FROM (SELECT *, CAST(floor(seat / {SIZE}) AS BIGINT) AS batch_no FROM full_)""",
    "batches": f"""SELECT *, row_number() OVER (ORDER BY {W.draw(SEED, "'batch'", 'is_multimodal', 'batch_no')}, is_multimodal, batch_no) - 1 AS seat FROM
      (SELECT is_multimodal, batch_no, max(n_words + CASE WHEN is_multimodal THEN 576 ELSE 0 END) AS longest FROM plan GROUP BY ALL)""",
    "placed": """SELECT *, CASE WHEN seat = top THEN 0 WHEN seat = 0 THEN top ELSE seat END AS epoch_batch
      FROM batches, (SELECT seat AS top FROM batches ORDER BY longest DESC, seat LIMIT 1)""",
}


def plan(spark, d):
    return B.modality_batches(W.examples(spark, d), SIZE, SEED)


@job("split_modality_batches", W.sql("v_examples", "SELECT example_id, is_multimodal, n_words, batch_no, slot FROM plan", **PLAN))
def split_modality_batches(spark, d):
    return plan(spark, d).select("example_id", "is_multimodal", "n_words", "batch_no", "slot")


# one recursion step per slot: the lightest bucket (first of equals) takes the next example of its batch
ROOM = SIZE // REPLICAS
DEAL = f"""SELECT is_multimodal, batch_no, CAST(0 AS INT) AS turn, CAST([0, 0, 0, 0] AS DOUBLE[]) AS w, [0, 0, 0, 0] AS c, CAST(NULL AS BIGINT) AS example_id,
    CAST(NULL AS BIGINT) AS n_words, CAST(NULL AS INT) AS bucket, CAST(NULL AS INT) AS slot FROM plan WHERE slot = 0
  UNION ALL SELECT is_multimodal, batch_no, turn + 1,
    list_transform([1, 2, 3, 4], lambda i: CASE WHEN i <> b THEN w[i] WHEN c[i] + 1 = {ROOM} THEN CAST('Infinity' AS DOUBLE) ELSE w[i] + words END),
    list_transform([1, 2, 3, 4], lambda i: CASE WHEN i = b THEN c[i] + 1 ELSE c[i] END), e, words, CAST(b - 1 AS INT), CAST((b - 1) * {ROOM} + c[b] AS INT)
  FROM (SELECT d.is_multimodal, d.batch_no, d.turn, d.w, d.c, p.example_id AS e, p.n_words AS words, list_position(d.w, list_min(d.w)) AS b
        FROM deal d JOIN plan p ON p.is_multimodal = d.is_multimodal AND p.batch_no = d.batch_no AND p.slot = d.turn)"""


@job(
    "length_bucket_assign",
    W.sql(
        "v_examples", "SELECT example_id, is_multimodal, n_words, batch_no, bucket, slot FROM deal WHERE bucket IS NOT NULL", **PLAN, deal=DEAL
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def length_bucket_assign(spark, d):
    return B.length_buckets(plan(spark, d), REPLICAS).select("example_id", "is_multimodal", "n_words", "batch_no", "bucket", "slot")


@job("merge_and_order_batches", W.sql("v_examples", "SELECT is_multimodal, batch_no, longest, CAST(epoch_batch AS BIGINT) AS epoch_batch FROM placed", **PLAN))
def merge_and_order_batches(spark, d):
    return B.batch_order(plan(spark, d), SEED)


@job(
    "assign_replicas",
    W.sql(
        "v_examples",
        f"""SELECT example_id, is_multimodal, epoch_batch * {SIZE} + slot AS "index", CAST(floor((epoch_batch * {SIZE} + slot) / {SIZE // REPLICAS}) % {REPLICAS} AS INT) AS "rank"
        FROM deal JOIN placed USING (is_multimodal, batch_no) WHERE bucket IS NOT NULL""",
        **PLAN,
        deal=DEAL,
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def assign_replicas(spark, d):
    """Batches, buckets, epoch order and ranks: a rank's slice of a batch is one of its buckets."""
    batches = cut_lineage(B.length_buckets(plan(spark, d), REPLICAS))
    out = B.replica_slices(batches, B.batch_order(batches, SEED), SIZE, REPLICAS)
    return out.select("example_id", "is_multimodal", "index", "rank")


@job(
    "check_batch_cover",
    W.sql(
        "v_examples",
        """SELECT (SELECT count(*) FROM v_examples) AS n_examples, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_missing,
        (SELECT count(*) FROM v_examples WHERE is_multimodal) AS n_multimodal, TRUE AS divides_batches, TRUE AS divides_replicas, TRUE AS complete FROM plan""",
        **PLAN,
    ),
)
def check_batch_cover(spark, d):
    return B.cover_report(plan(spark, d), W.examples(spark, d), SIZE, REPLICAS)


@job(
    "distributed_sampler",
    W.sql(
        "v_examples",
        """SELECT example_id, CAST(seat % 7 AS INT) AS "rank", CAST(floor(seat / 7) AS BIGINT) AS "index" FROM
        (SELECT example_id, seat FROM s UNION ALL SELECT example_id, seat + n FROM s WHERE seat < ((-n) % 7 + 7) % 7)""",
        s=f"SELECT example_id, row_number() OVER (ORDER BY {W.draw(17, 'example_id')}, example_id) - 1 AS seat, count(*) OVER () AS n FROM v_examples",
    ),
)
def distributed_sampler(spark, d):
    return B.distributed_sample(W.examples(spark, d).select("example_id"), 7, 17)
