"""Source manifests, inventories, image work lists, evaluation manifests, annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, values
from ..operators.contract import Node, valid_object_id
from .transcriptions import read_text_files

ARRAY_OF_DOCUMENTS = "array<variant>"


def manifest_documents(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of source manifests (value): version 0.1, documents list."""
    doc = Node(F.try_parse_json("value"))
    usable = F.coalesce(doc["version"].string == "0.1", F.lit(False)) & doc["documents"].is_array
    rows = manifests.filter(usable).select(F.explode(doc["documents"].items).alias("record"))
    record = Node(F.col("record"))
    pages = record["pages"].items
    documents = rows.select(
        record["id"].string.alias("doc_id"),
        record["source_type"].string.alias("source_type"),
        record["format"].string.alias("format"),
        record["prompt_profile"].string.alias("prompt_profile"),
        record["metadata"].cast("variant").alias("metadata"),
        F.coalesce(F.size(pages), F.lit(0)).alias("declared_pages"),
        pages.alias("pages"),
    )
    errors = manifests.filter(~usable).select(
        F.lit("source manifest needs version '0.1' and a documents list").alias("error"), F.lit("manifest").alias("stage")
    )
    return documents, errors


def manifest_page_problems(documents: DataFrame) -> DataFrame:
    """Page rules of declared documents: numbering, addresses, all-or-none images."""
    page = Node(F.col("page_record"))
    rows = documents.select("doc_id", F.posexplode("pages").alias("position", "page_record")).select(
        "doc_id",
        page["page"].integer.eqNullSafe(F.col("position").cast("bigint") + 1).alias("in_sequence"),
        (~page["image_url"].missing).alias("has_url"),
        (page["image_url"].missing | text.is_safe_url(page["image_url"].string)).alias("url_ok"),
    )
    per_document = rows.groupBy("doc_id").agg(
        F.bool_and("in_sequence").alias("in_sequence"),
        F.bool_and("url_ok").alias("url_ok"),
        F.count_if("has_url").alias("urls"),
        F.count(F.lit(1)).alias("pages"),
    )
    found = F.array_compact(
        F.array(
            F.when(~F.col("in_sequence"), "page_numbers"),
            F.when(~F.col("url_ok"), "image_url"),
            F.when((F.col("urls") > 0) & (F.col("urls") != F.col("pages")), "mixed_images"),
        )
    )
    bad_ids = documents.filter(~valid_object_id(F.col("doc_id"))).select("doc_id", F.lit("document_id").alias("code"))
    return per_document.select("doc_id", F.explode(found).alias("code")).unionByName(bad_ids)


def manifest_image_urls(documents: DataFrame) -> DataFrame:
    """(doc_id, page, url) of declared pages."""
    page = Node(F.col("page_record"))
    return documents.select("doc_id", F.explode("pages").alias("page_record")).select(
        "doc_id", page["page"].integer.cast("int").alias("page"), page["image_url"].string.alias("url")
    ).filter("url IS NOT NULL")


def read_source_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return manifest_documents(spark.read.text(path, wholetext=True))


def inventory_rows(files: DataFrame) -> DataFrame:
    """Documents of inventory files (value); malformed entries are dropped."""
    documents = Node(F.try_parse_json("value"))["documents"].items
    rows = files.select(F.explode(documents).alias("record"))
    record = Node(F.col("record"))
    return rows.filter(record.is_object & record["id"].is_string).select(
        record["id"].string.alias("id"),
        record["source_type"].string.alias("source_type"),
        record["pages"].integer.cast("int").alias("pages"),
        record["format"].string.alias("format"),
        record["path"].string.alias("path"),
        record["metadata"].cast("variant").alias("metadata"),
        record["prompt_profile"].string.alias("prompt_profile"),
        record["transcribable"].cast("boolean").alias("transcribable"),
    )


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return inventory_rows(spark.read.text(path, wholetext=True))


def image_manifest_rows(files: DataFrame) -> DataFrame:
    """Pages of image manifests (object_id, value)."""
    pages = Node(F.try_parse_json("value"))["pages"].items
    rows = files.select("object_id", F.posexplode(pages).alias("position", "record"))
    record = Node(F.col("record"))
    return rows.select(
        "object_id",
        "position",
        record["page"].integer.cast("int").alias("page"),
        *[record[f].string.alias(f) for f in ("filename", "sha256", "image_url", "error")],
    )


def remote_images(metadata: DataFrame, column: str = "metadata") -> DataFrame:
    """(object_id, page, url) from the image_urls of a metadata VARIANT."""
    urls = F.try_variant_get(F.col(column), "$.image_urls", "variant")
    return metadata.select("object_id", F.inline(values.url_entries(urls)))


def remote_images_of_markup(documents: DataFrame) -> DataFrame:
    """(object_id, page, url) from facsimile lists: page break number, else position."""
    from ..plans.reading import attribute, tag_pattern, without_prefixes

    plain = without_prefixes(F.col("markup"))
    base = documents.select("object_id", plain.alias("_plain"))
    images = F.regexp_extract_all(
        F.regexp_extract("_plain", r"(?s)<facsimile\b.*?</facsimile>", 0), F.lit(tag_pattern("graphic")), F.lit(0)
    )
    body = F.regexp_extract("_plain", rf"(?s){tag_pattern('body')}(.*)</body>", 1)
    breaks = F.regexp_extract_all(body, F.lit(tag_pattern("pb")), F.lit(0))
    graphics = base.select("object_id", F.posexplode(images).alias("position", "tag")).select(
        "object_id",
        (F.col("position") + 1).alias("position"),
        attribute(F.col("tag"), r"(?:xml:)?id").alias("image_id"),
        attribute(F.col("tag"), "url").alias("url"),
    )
    pointers = base.select("object_id", F.posexplode(breaks).alias("position", "tag")).select(
        "object_id",
        "position",
        F.regexp_extract(attribute(F.col("tag"), "facs"), r"^#(.+)$", 1).alias("image_id"),
        attribute(F.col("tag"), "n").alias("n"),
    ).filter((F.col("image_id") != "") & F.col("n").rlike(r"^[0-9]+$"))
    last = pointers.groupBy("object_id", "image_id").agg(
        F.max_by(F.col("n").cast("int"), "position").alias("page")
    )
    return (
        graphics.filter(F.col("url").startswith("http"))
        .join(last, ["object_id", "image_id"], "left")
        .select("object_id", F.coalesce("page", "position").alias("page"), "url")
    )


def evaluation_fixtures(manifests: DataFrame) -> DataFrame:
    """Fixtures of evaluation manifests (value) with inherited defaults."""
    doc = Node(F.try_parse_json("value"))
    rows = manifests.select(
        doc["name"].string.alias("manifest"), doc["profile"].string.alias("_profile"),
        doc["relaxng_schema"].string.alias("_schema"), F.explode(doc["fixtures"].items).alias("record"),
    )
    item = Node(F.col("record"))
    side = "struct<kind:string,path:string,sha256:string,pages:array<int>>"
    hypothesis, reference = item["hypothesis"].cast(side), item["reference"].cast(side)

    def default(node: Node, value: Column | str) -> Column:
        return F.coalesce(node.string, F.lit(value) if isinstance(value, str) else value)

    return rows.select(
        "manifest",
        item["id"].string.alias("fixture_id"),
        item["checks"].cast("array<string>").alias("checks"),
        default(item["profile"], F.col("_profile")).alias("profile"),
        hypothesis.alias("hypothesis"),
        reference.alias("reference"),
        hypothesis.isNotNull().alias("has_hypothesis"),
        reference.isNotNull().alias("has_reference"),
        hypothesis["kind"].alias("hypothesis_kind"),
        item["tei"]["path"].string.alias("tei_path"),
        default(item["tei"]["relaxng_schema"], F.col("_schema")).alias("relaxng_schema"),
        default(item["scope"], "all").alias("scope"),
        default(item["reference_class"], "none").alias("reference_class"),
        item["maturity"].string.alias("maturity"),
        item["git_anchor"].string.alias("git_anchor"),
    )


def read_evaluation_manifest(spark: SparkSession, path: str) -> DataFrame:
    return evaluation_fixtures(spark.read.text(path, wholetext=True))


def proposals(files: DataFrame) -> DataFrame:
    """Correction proposals (object_id, id, value); unreadable ones stay as error rows."""
    doc = Node(F.try_parse_json("value"))
    readable = doc.is_object
    return files.select(
        "object_id",
        "id",
        *[
            F.when(readable, doc[f].string).alias(f)
            for f in ("version", "transcription", "notes", "actor", "actor_kind", "note")
        ],
        F.when(readable, doc["page"].integer.cast("int")).alias("page"),
        F.when(~readable, "Unreadable proposal").alias("error"),
    )


def read_proposals(spark: SparkSession, path: str) -> DataFrame:
    """Proposals of ``path/{object_id}/{id}.json``."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    source = F.col("_metadata.file_path")
    return proposals(
        files.select(
            F.regexp_extract(source, r"([^/]+)/[^/]+$", 1).alias("object_id"),
            F.regexp_extract(source, r"([^/]+)\.json$", 1).alias("id"),
            "value",
        )
    )


def annotations(files: DataFrame) -> DataFrame:
    """Annotation bindings (object_id, value): readable flag and bound hash."""
    doc = Node(F.try_parse_json("value"))
    return files.select(
        "object_id",
        (doc.is_object & (doc["_meta"].missing | doc["_meta"].is_object)).alias("readable"),
        doc["_meta"]["transcription_sha256"].string.alias("binding"),
    )


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    return annotations(read_text_files(spark, path))


def call_records(files: DataFrame) -> DataFrame:
    """Model call records (object_id, value): one per call, answer or error."""
    doc = Node(F.try_parse_json("value"))
    return files.select(
        "object_id",
        doc["chunk"].integer.cast("int").alias("chunk"),
        doc["attempt"].integer.cast("int").alias("attempt"),
        doc["page"].integer.cast("int").alias("page"),
        doc["pages"].cast("array<int>").alias("pages"),
        *[doc[f].string.alias(f) for f in ("provider", "model", "prompt_hash", "answer", "error")],
    )


def read_call_records(spark: SparkSession, path: str) -> DataFrame:
    """Call records of ``path/{object_id}/*.json``."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return call_records(
        files.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("object_id"), "value")
    )


def markup_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of a folder of XML files."""
    from ..plans.reading import with_well_formed

    files = read_text_files(spark, path, "*.xml").withColumnRenamed("value", "markup")
    checked = with_well_formed(files)
    errors = checked.filter(~F.col("well_formed")).select(
        "object_id", F.lit("XML parse error").alias("error"), F.lit("read").alias("stage")
    )
    return checked.filter("well_formed").drop("well_formed"), errors
