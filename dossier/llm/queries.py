"""The registered queries of this package, each over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.chat import as_events, format_logs, read_back
from dossier.llm.compression import ENTRIES, PARTS, ROUNDS, SCALE, compress_vectors
from dossier.llm.decontamination import find_copies
from dossier.llm.licenses import license_labels, scan_licenses
from dossier.llm.lines import document_report
from dossier.llm.mixing import mixture_sizes
from dossier.llm.quality import quality_verdicts
from dossier.llm.scoring import is_held_out, score_documents
from dossier.llm.simhash import simhash_groups
from dossier.llm.tables import read_table
from dossier.llm.tokens import count_tokens
from dossier.llm.urls import RULES, judge_urls, labelled_by_rules, train
from dossier.llm.warc import round_trip
from dossier.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed values of the contracts.
TOKENIZER = "word_bpe_49k.json"
MAX_TOKENS = 2048
PROBE = "<|im_end|><|im_start|>assistant ok"


def _query(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_token_counts(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tokenizer_path()).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit")
    )


@_query
def op2_decontamination(spark, sf_dir):
    """A row for each document and benchmark item of which it holds a copy."""
    return find_copies(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query
def op3_simhash(spark, sf_dir):
    return simhash_groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op4_lm_scores(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    training = docs.where(~is_held_out(F.col("doc_id")))
    return score_documents(docs, training).withColumn("held_out", is_held_out(F.col("doc_id")))


@_query
def op5_warc(spark, sf_dir):
    records = round_trip(spark, read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op6_mixing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixture_sizes(docs)


def chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and -1, whose texts look like marks."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        role.alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return turns.unionByName(probe)


@_query
def op7_line_dedup(spark, sf_dir):
    """The lines removed from each document, by their places, those of one or two words by themselves; and each linked
    line's class and number of links."""
    return document_report(read_table(spark, sf_dir, "documents").select("doc_id", "text"), links=True)


@_query
def op8_chat_format(spark, sf_dir):
    chats = read_back(format_logs(as_events(chat_turns(spark, sf_dir))))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ORACLE["op8_chat_format"] = f"""
WITH turns AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}'
  UNION ALL SELECT -1, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
                    ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                             ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || replace(replace(role, '&', '&amp;'), '<|', '&lt;|') || chr(10)
    || replace(replace(text, '&', '&amp;'), '<|', '&lt;|') || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@_query
def op9_quality_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality_verdicts(docs)
    return judged.select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "broken_rules",
    )


@_query
def op10_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    classifier = train(labelled_by_rules(pages, RULES))
    return judge_urls(pages, RULES, classifier).select(
        "page_id", "host", "path", "rule", "verdict", "block_score"
    )


@_query
def op11_license_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_labels(scan_licenses(docs))


@_query
def op12_vector_codes(spark, sf_dir):
    return compress_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def _codes_sql() -> str:
    """Each round as a table of nearest entries and one of new entries."""
    square = "list_sum(list_transform(list_zip(t.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    tables = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v, len(embedding) // {PARTS} AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT row, p, list_slice(v, p * w + 1, p * w + w) AS x FROM kept, range({PARTS}) AS r(p))""",
        f"""c0 AS MATERIALIZED (SELECT p, row - 1 AS e, x FROM parts WHERE row <= {ENTRIES})""",
    ]
    for i in range(ROUNDS + 1):
        tables.append(f"""a{i} AS MATERIALIZED (SELECT t.row, t.p, min({square} * {ENTRIES} + c.e) AS best
  FROM parts t JOIN c{i} c USING (p) GROUP BY t.row, t.p)""")
        if i < ROUNDS:
            tables.append(f"""c{i + 1} AS MATERIALIZED (SELECT p, e, COALESCE(n.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS x FROM (
      SELECT p, best % {ENTRIES} AS e, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n
      FROM a{i} JOIN parts USING (row, p), LATERAL unnest(range(1, len(x) + 1)) AS u(k) GROUP BY ALL)
    GROUP BY p, e) n USING (p, e))""")
    return f"""WITH {", ".join(tables)},
  codes AS (SELECT row, string_agg(printf('%02x', CAST(best % {ENTRIES} AS INTEGER)), '' ORDER BY p) AS code,
    CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY row),
  books AS (SELECT sha256(string_agg(CAST(x[k] AS VARCHAR), ',' ORDER BY p, e, k)) AS codebooks_sha256
    FROM c{ROUNDS}, LATERAL unnest(range(1, len(x) + 1)) AS u(k))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (row), books"""


ORACLE["op12_vector_codes"] = _codes_sql()


@_query
def op13_whitening(spark, sf_dir):
    """For each vector and component: the whitened coordinate, the vector's exact distance from the mean, the shares."""
    return whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
