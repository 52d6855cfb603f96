"""The registered queries of this subpackage: thin calls over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import chat_formatting
from .common import documents
from .fingerprints import document_fingerprints
from .media import media_columns
from .near_dedup import near_duplicates
from .packing import pack_documents
from .quality import quality_scores
from .secrets_scan import secret_spans
from .sentencepieces import sentencepiece_digests
from .substring_dedup import substring_dedup
from .tokens import token_counts


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=4, percent=80)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), window=35)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(documents(spark, sf_dir))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(documents(spark, sf_dir), radius=3)


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), limit=2048)


def op7_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_digests(documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(documents(spark, sf_dir), labels, label="quality", threshold=0.3).drop("_kept")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat_formatting(conversations.unionByName(added))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_media_columns": op5_media_columns,
    "op6_token_counts": op6_token_counts,
    "op7_sentencepiece_round_trip": op7_sentencepiece_round_trip,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_chat_formatting": op10_chat_formatting,
}

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Links by common shingles, grouped by walking them.
_COMPONENTS = f"""WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle FROM docs, unnest(range(1, greatest(len(w) - 2, 2))) AS u(i) WHERE len(w) > 0),
sized AS (SELECT doc_id, count(shingle) AS n FROM docs LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
single AS (SELECT * FROM shingles JOIN sized USING (doc_id)),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
pairs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS origin, doc_id AS node FROM sized UNION SELECT r.origin, e.b FROM reached r JOIN pairs e ON r.node = e.a),
low AS (SELECT origin AS doc_id, min(node) AS component_id FROM reached GROUP BY origin)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN low USING (doc_id)"""

#: Windows by the texts of their words; a word goes if one that repeats began at most 34 before it.
_PASSAGES = f"""WITH docs AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS said FROM docs, unnest(range(1, len(w) - 33)) AS u(i)),
repeated AS (SELECT said FROM windows GROUP BY said HAVING count(*) > 1),
begun AS (SELECT doc_id, i FROM windows JOIN repeated USING (said)),
words AS (SELECT doc_id, i, w[i] AS word FROM docs, unnest(range(1, len(w) + 1)) AS u(i)),
marked AS (SELECT doc_id, i, word, max(begun.i IS NOT NULL) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM words LEFT JOIN begun USING (doc_id, i)),
kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256 FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id"""

_ESCAPED = r"regexp_replace({text}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"

_CHATS = f"""WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(length({_ESCAPED.format(text=r"replace(replace(role, '\', '\\'), chr(10), '\n')")}) + length({_ESCAPED.format(text='text')}) + 8) AS BIGINT) AS formatted_chars FROM said GROUP BY conv_id"""

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": _COMPONENTS,
    "op2_substring_dedup": _PASSAGES,
    "op10_chat_formatting": _CHATS,
}
