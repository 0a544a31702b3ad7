"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import importlib.util
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import functions as F

from ledgerlark.llm import (
    ann_search,
    archives,
    hamming_search,
    html_extract,
    language_id,
    line_dedup,
    merkle,
    near_dedup,
    packing,
    phrases,
    piece_codec,
    secret_scan,
    url_filter,
)


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files lie on this machine."""
    if importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers

        return public_tokenizers.path(name)
    return f"/opt/tokenizers/{name}"


WORD_TOKENIZER, PIECE_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"


_shipped: set[str] = set()


def ship_package(spark) -> None:
    """Send the package's sources to the Python workers, once for each application, as
    ``--py-files`` would: a worker need not have them on its own path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ledgerlark-src-")) / "ledgerlark_src.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def _table(spark, sf_dir, name):
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark, sf_dir):
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_secret_scan(spark, sf_dir):
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))
    columns = secret_scan.digest_columns(F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)))
    return found.select("doc_id", *(column.alias(name) for name, column in columns.items()))


def op3_ann_search(spark, sf_dir):
    return ann_search.nearest_vectors(_table(spark, sf_dir, "embeddings"), lambda id: id % 50 == 0, k=5)


def op4_warc_convert(spark, sf_dir):
    arcs = archives.write_arc(_table(spark, sf_dir, "pages"))
    records = archives.read_warc(archives.arc_to_warc(arcs), with_payload=False)
    return records.select(
        F.col("item").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to_item").alias("refers_to"),
    )


def op5_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_hamming_search(spark, sf_dir):
    codes = hamming_search.sign_codes(_table(spark, sf_dir, "embeddings"))
    return hamming_search.nearest_codes(codes, lambda id: id % 20 == 0, k=10)


def op7_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op8_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_shared_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_piece_codec(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return piece_codec.encode_pieces(docs, tokenizer_path(PIECE_MODEL), digests=True)


def op11_phrase_collocations(spark, sf_dir):
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    cut = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0, F.replace("text", F.lit("\n")))
    fields = ("doc_id", "source", "lang", "n_chars")
    rows = docs.select(
        "doc_id",
        "source",
        merkle.leaf_digest(*map(F.col, fields), F.col("text")).alias("leaf"),
        merkle.leaf_digest(*map(F.col, fields), F.coalesce(cut, "text")).alias("claimed"),
    )
    proofs = merkle.manifest(rows, id="doc_id", group="source", leaf="leaf", carry=["claimed"])
    folded = proofs.withColumns(
        {
            "proof_sha256": merkle.proof_digest(F.col("path")),
            "folded_root": merkle.folded(F.col("claimed"), F.col("path")),
        }
    ).drop("path", "claimed")
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_html_extract(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def pipeline(spark, sf_dir):
    import corpus_pipeline

    ship_package(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_secret_scan,
        op3_ann_search,
        op4_warc_convert,
        op5_language_id,
        op6_hamming_search,
        op7_packing,
        op8_near_dedup,
        op9_line_dedup,
        op10_piece_codec,
        op11_phrase_collocations,
        op12_merkle_manifest,
        op13_html_extract,
        pipeline,
    )
}
