"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, html_crf, langid, licences, media, mixing, pieces, simhash, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, n: int) -> Column:
    """crc32 of an id as text, modulo n; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(n))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the labels outside the fold 1 of 3."""
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.train(documents, _table(spark, sf_dir, "labels"), "doc_id", "text", "toxic", usable=fold("doc_id", 3) != 1)
    return toxicity.scores(documents, model, "doc_id", "text").select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts stored as media archives and described from what is read back."""
    return media.media_round_trip(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, its own or its directory's.

    Documents lie by source, thousand and hundred of their ids; a null source
    or id is an empty name on its level.
    """
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    path = F.concat_ws("/", name(F.col("source")), name(F.floor(F.col("doc_id") / 1000)), name(F.floor(F.col("doc_id") / 100)), name(F.col("doc_id")))
    return licences.scan(_table(spark, sf_dir, "documents"), "doc_id", "text", path)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings to each whose id 20 divides."""
    return ann.search(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=20, every=20)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_crf.extract(_table(spark, sf_dir, "pages"), id_cols=("page_id", "url"), html_col="html").select(
        "row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source: weights 5, 2, 1, 150% of all words, no source or document above 2 times its own."""
    return mixing.mix(_table(spark, sf_dir, "documents"), "doc_id", "text", "source", weights=(5, 2, 1), share=1.5, cap=2.0)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives, normalised, and read back by offset."""
    return warc.warc_round_trip(_table(spark, sf_dir, "pages"), "page_id", "url", "html", min_bytes=0)


#: The session's setting that names a SentencePiece model file; where it is unset, the installed public 32k BPE model.
PIECES = "spark.quillframe.pieceModel"


def piece_model(spark: SparkSession) -> pieces.Model:
    path = spark.conf.get(PIECES, None)
    if not path:
        try:
            import public_tokenizers
        except ImportError as e:
            raise ValueError(f"set {PIECES} to a SentencePiece model file") from e
        path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.Model.load(path)


def token_rows(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of all ``documents``."""
    found = pieces.encode(documents, piece_model(spark), "doc_id", "text", with_text=True)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all texts, and the digest of the text that they decode to."""
    return token_rows(spark, _table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, 4 differing bits."""
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"), "doc_id", "text", words=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from the documents outside the fold 2 of 4."""
    documents = _table(spark, sf_dir, "documents")
    model = langid.train(documents, "text", "lang", usable=fold("doc_id", 4) != 2)
    return langid.detect(documents, model, "doc_id", "text").select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_spans"
    )


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_media_columns": op2_media_columns,
        "op3_licences": op3_licences,
        "op4_nearest": op4_nearest,
        "op5_html_extraction": op5_html_extraction,
        "op6_mixing": op6_mixing,
        "op7_warc": op7_warc,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_simhash": op9_simhash,
        "op10_language_id": op10_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {}
