"""The text operators on the tables they are meant for, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.llm import chat, decontaminate, exact_dedup, extraction, negatives, packing, pii, quality, secret_scan, simhash, substrings, tries, warc
from hourgrid.llm.common import kept, table
from hourgrid.session import scratch_path

#: Rows the quality classifier must not learn from.
HELD_OUT = "crc32(CAST(doc_id AS string)) % 5 = 0"


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Trees:
    return quality.train(docs, labels.where(f"NOT ({HELD_OUT})"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.scored(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return found.withColumnRenamed("id", "doc_id").select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", "predicted")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(table(spark, sf_dir, "pages"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonyms(table(spark, sf_dir, "documents"), key="hourgrid")
    return found.drop("row").withColumnRenamed("id", "doc_id")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scanned(docs, secret_scan.train(docs))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.content_groups(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP7_SQL = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY norm)
"""


def chains(conversations: DataFrame) -> DataFrame:
    """Messages of linear conversations as reply trees: each answers the one before it; ties by role and text.

    Rows without ``conv_id`` form one conversation, which like any other is sorted and formatted in one task.
    """
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    numbered = conversations.select(name.alias("conv"), place.alias("place"), "role", "text")
    return numbered.select(
        F.concat_ws(":", "conv", "place").alias("node"), F.when(F.col("place") > 1, F.concat_ws(":", "conv", F.col("place") - 1)).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text",
    )


#: A conversation that tries to spell the marks of the template.
SLY = r"\### Assistant: </turn> ok"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    sly = spark.range(2).selectExpr("-7L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role").withColumn("text", F.lit(SLY))
    written = chat.conversations(chains(given.unionByName(sly)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for leaf, whole, mask in zip(*(c.to_pylist() for c in batch.columns)):
                turns = chat.parsed(whole)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                loss = chat.learned(whole, [(m["start"], m["end"]) for m in mask])
                sha = [hashlib.sha256(x.encode("utf-8")).hexdigest() for x in (said, loss)]
                rows.append((leaf.partition(":")[0], len(turns), sha[0], len(loss), sha[1], len(whole)))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], pa.schema(zip(names, kinds)))

    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    found = written.mapInArrow(read, "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return found.select(F.expr("try_cast(conv AS bigint)").alias("conv_id"), *names[1:])


OP8_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) AS r(i)
), sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS body,
         length(role) + length(regexp_replace(role, '[^\\#<:\n]', '', 'g')) AS head FROM given
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + head + 2 + body + 8) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "warc")
    found = warc.read_archives(warc.write_archives(pages, folder), folder)
    kind = pages.schema["page_id"].dataType
    return found.select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


OP9_SQL = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM sized
), marked AS (
  SELECT *, payload_bytes >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last AS again FROM grouped
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN last END AS refers_to FROM marked
"""


def tokenizer() -> str:
    """The vocabulary file that documents are packed with; only packing needs its package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer())


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), placed AS (
  SELECT doc_id, i, words[i] AS word, CASE WHEN i + 19 <= len(words) THEN array_to_string(words[i : i + 19], ' ') END AS span
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM split)
), judged AS (
  SELECT *, span IS NOT NULL AND row_number() OVER (PARTITION BY span ORDER BY doc_id, i) > 1 AS again FROM placed
), covered AS (
  SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM judged
), found AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN found f ON s.doc_id = f.doc_id
"""


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


OP12_SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
), whole AS (
  SELECT vec_id, label, list_transform(x, lambda v: CAST(floor(256 * v) AS DOUBLE)) AS v FROM given
  WHERE len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER best <= 10
"""


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and members after each conversation c got the first h turns of conversation c - c % 100 for its own first h."""
    h = F.expr("crc32(CAST(CAST(conv AS string) AS binary)) % 6")
    base = F.col("conv") - F.col("conv") % 100
    members = turns.select("conv").distinct()
    heads = turns.where("conv % 100 = 0 AND pos <= 5").select(F.col("conv").alias("base"), F.col("pos").alias("head"), "a", "b", "size")
    taken = members.select("conv", h.alias("h"), base.alias("base")).join(heads, "base").where("head <= h")
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    own = turns.select("*", h.alias("h"), base.alias("base")).where("pos > h").join(lengths, "base", "left")
    place = F.col("pos") - F.col("h") + F.least("h", F.coalesce("n", F.lit(0)))
    both = taken.select("conv", F.col("head").alias("pos"), "a", "b", "size").unionByName(own.select("conv", place.alias("pos"), "a", "b", "size"))
    return both, members


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(*rebuilt(kept(tries.ordered_turns(table(spark, sf_dir, "conversations")))))


# CRC-32 bit by bit: a byte is added, then eight steps, marked -1, shift it out
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(c.conv_id AS VARCHAR), ''),
  lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda s, v: CASE WHEN v >= 0 THEN xor(s, v) WHEN (s & 1) = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295)"""
OP13_SQL = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL
), listed AS (
  SELECT conv_id, list(said ORDER BY pos) AS turns FROM own GROUP BY conv_id
), sized AS (
  SELECT c.conv_id, {CRC32_SQL} % 6 AS h, c.turns, b.turns AS head FROM listed c LEFT JOIN listed b ON b.conv_id = c.conv_id - c.conv_id % 100
), whole AS (
  SELECT conv_id, list_concat(coalesce(head[1:h], []), turns[h + 1:]) AS turns FROM sized
), member AS (
  SELECT conv_id, turns, d, turns[1:d] AS node FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM whole)
), node AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = d), '')) AS ends_sha256,
         CASE WHEN any_value(d) > 0 THEN (count(*) - 1) * length(node[any_value(d)].t) ELSE 0 END AS saved
  FROM member GROUP BY node
), child AS (
  SELECT node[1:depth - 1] AS up, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), known AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id FROM node n
  LEFT JOIN child c ON c.up = n.node LEFT JOIN node p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
), above AS (
  SELECT node, n_children, saved, unnest(range(0, depth + 1)) AS d FROM known
), subtree AS (
  SELECT node[1:d] AS top, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY ALL
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM known JOIN subtree ON top = node
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_html": op3_html,
    "op4_pii": op4_pii,
    "op5_secrets": op5_secrets,
    "op6_decontaminate": op6_decontaminate,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_chat": op8_chat,
    "op9_warc": op9_warc,
    "op10_packing": op10_packing,
    "op11_substrings": op11_substrings,
    "op12_negatives": op12_negatives,
    "op13_trie": op13_trie,
}

ORACLES: dict[str, str] = {"op7_exact_dedup": OP7_SQL, "op8_chat": OP8_SQL, "op9_warc": OP9_SQL, "op11_substrings": OP11_SQL, "op12_negatives": OP12_SQL, "op13_trie": OP13_SQL}
