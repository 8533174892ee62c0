"""Sources, inventory and image manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contract
from ..plans import inventory
from ..sources import files, manifests
from ..operators.ordered import in_order
from .registry import query

FOUND = r"""
    SELECT doc_id, arg_min(source_type, path) AS source_type, count(*) AS pages, arg_min(format, path) AS format,
           arg_min(folder, path) AS path, count(*) AS files
    FROM (SELECT path, regexp_extract(lower(path), '\.([^./]+)$', 1) AS format,
                 CASE WHEN ends_with(path, '.pdf') THEN 'pdf' WHEN ends_with(path, '.jpg') OR ends_with(path, '.TIFF') THEN 'image'
                      WHEN ends_with(path, '.txt') THEN 'text' WHEN ends_with(path, '.json') THEN 'transcription' END AS source_type,
                 CASE WHEN starts_with(path, 'images/') THEN split_part(path, '/', 2) ELSE regexp_extract(path, '([^/]*)\.[^.]*$', 1) END AS doc_id,
                 CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '.' END AS folder
          FROM files_v WHERE NOT ends_with(path, '.md') AND NOT ends_with(path, '/manifest.json'))
    GROUP BY doc_id"""

MERGED = """
    SELECT coalesce(f.doc_id, d.doc_id) AS doc_id, coalesce(f.source_type, 'remote_images') AS source_type,
           coalesce(f.pages, CAST(d.declared_pages AS BIGINT), 0) AS pages, coalesce(f.format, 'remote') AS format,
           coalesce(f.path, 'manifest.json') AS path, CASE WHEN d.declared_pages > 0 THEN d.declared_pages END AS declared_pages,
           d.language, d.prompt_profile
    FROM found f FULL JOIN declared_v d ON d.doc_id = f.doc_id"""

MATERIALIZED = """
    SELECT 'remote-' || CAST(doc_id AS STRING) AS doc_id, CAST(doc_id % 3 AS INT) AS materialized_pages, 'jpg' AS image_format
    FROM documents"""

WITH_IMAGES = """
    SELECT coalesce(m.doc_id, i.doc_id) AS doc_id, coalesce(source_type, 'extracted_image') AS source_type,
           coalesce(pages, CAST(materialized_pages AS BIGINT)) AS pages, coalesce(format, image_format) AS format,
           coalesce(path, 'images/' || i.doc_id) AS path, declared_pages,
           CASE WHEN source_type IS NOT NULL THEN materialized_pages END AS materialized_pages, language, prompt_profile
    FROM merged m FULL JOIN materialized i ON i.doc_id = m.doc_id"""

INVENTORY = """
    SELECT doc_id AS id, source_type, coalesce(CAST(declared_pages AS BIGINT), CAST(materialized_pages AS BIGINT), pages) AS pages, format, path, language, prompt_profile,
           source_type IN ('pdf', 'image', 'remote_images', 'extracted_image') OR coalesce(materialized_pages, 0) > 0 AS transcribable
    FROM with_images"""

BLOCKS = {"found": FOUND, "merged": MERGED, "materialized": MATERIALIZED, "with_images": WITH_IMAGES, "inventory_rows": INVENTORY}


def blocks(last: str) -> dict[str, str]:
    names = list(BLOCKS)
    return {n: BLOCKS[n] for n in names[: names.index(last) + 1]}


def merged(t):
    return inventory.merge_declared(files.classify_sources(t.files_v), t.declared_v)


def with_images(t):
    images = t.documents.select(
        F.concat(F.lit("remote-"), F.col("doc_id").cast("string")).alias("doc_id"),
        (F.col("doc_id") % 3).cast("int").alias("materialized_pages"),
        F.lit("jpg").alias("image_format"),
    )
    return inventory.merge_images(merged(t), images)


@query("src03_source_classification", "SELECT * FROM found", blocks("found"))
def _(t):
    return files.classify_sources(t.files_v)


@query("join01_files_and_manifest", "SELECT * FROM merged", blocks("merged"))
def _(t):
    return merged(t)


@query("join02_documents_and_images", "SELECT * FROM with_images", blocks("with_images"))
def _(t):
    return with_images(t)


@query(
    "join02_page_count_problems",
    """SELECT doc_id, CASE WHEN source_type = 'image' AND pages <> declared_pages THEN 'local_pages' ELSE 'materialized_pages' END AS code
       FROM with_images WHERE coalesce(source_type = 'image' AND pages <> declared_pages, FALSE) OR coalesce(materialized_pages <> declared_pages, FALSE)""",
    blocks("with_images"),
)
def _(t):
    return inventory.page_count_problems(with_images(t))


@query("job01_corpus_inventory", "SELECT * FROM inventory_rows", BLOCKS)
def _(t):
    return inventory.inventory(with_images(t))


@query("srt03_inventory_order", "SELECT id, row_number() OVER (ORDER BY id) AS position FROM inventory_rows", BLOCKS)
def _(t):
    # partitions of a sorted table follow each other, so the row numbers ascend with the order
    rows = inventory.inventory(with_images(t)).select("id").withColumn("row", F.monotonically_increasing_id())
    return in_order(rows, ["row"]).drop("row")


@query(
    "agg09_inventory_summary",
    "SELECT source_type, count(*) AS documents, CAST(sum(pages) AS BIGINT) AS pages FROM inventory_rows GROUP BY source_type",
    BLOCKS,
)
def _(t):
    return inventory.summary(inventory.inventory(with_images(t)))


@query(
    "snk01_inventory_markdown",
    """SELECT id, '| ' || id || ' | ' || source_type || ' | ' || CAST(pages AS STRING) || ' | ' || format || ' | ' || path || ' | ' ||
              CASE WHEN transcribable THEN 'yes' ELSE 'no, no page images' END || ' |' AS line FROM inventory_rows""",
    BLOCKS,
)
def _(t):
    return inventory.markdown_rows(inventory.inventory(with_images(t)))


@query(
    "prj06_transcribable_sample",
    "SELECT id FROM inventory_rows WHERE transcribable ORDER BY id LIMIT 25",
    BLOCKS,
)
def _(t):
    from ..operators.selection import select_objects

    rows = inventory.inventory(with_images(t)).filter("transcribable").withColumnRenamed("id", "object_id")
    return select_objects(rows, everything=True, sample=25).select(F.col("object_id").alias("id"))


@query(
    "src05_manifest_pages",
    """SELECT doc_id, code FROM (SELECT 'remote-' || CAST(doc_id AS STRING) AS doc_id, unnest([
         CASE WHEN doc_id % 7 = 2 THEN 'page_numbers' END, CASE WHEN doc_id % 5 = 3 THEN 'image_url' END,
         CASE WHEN doc_id % 3 = 1 THEN 'mixed_images' END]) AS code FROM documents) WHERE code IS NOT NULL""",
)
def _(t):
    n = F.col("doc_id")
    first = F.struct(
        F.when(n % 7 == 2, 2).otherwise(1).alias("page"),
        F.when(n % 5 == 3, "ftp://x/").otherwise("https://x/1").alias("image_url"),
    )
    second = F.struct(F.lit(2).alias("page"), F.when(n % 3 != 1, "https://x/2").alias("image_url"))
    record = F.struct(F.concat(F.lit("remote-"), n.cast("string")).alias("id"), F.array(first, second).alias("pages"))
    value = F.to_json(F.struct(F.lit("0.1").alias("version"), F.array(record).alias("documents")))
    documents, _errors = manifests.manifest_documents(t.documents.select(value.alias("value")))
    return manifests.manifest_page_problems(documents)


@query(
    "src06_join03_verified_manifest",
    """SELECT m.object_id, m.page, CASE WHEN m.error IS NOT NULL THEN 'extraction_error' WHEN contains(m.filename, '/') THEN 'filename'
              WHEN i.sha256 IS NULL THEN 'missing' WHEN i.sha256 <> m.sha256 THEN 'changed' END AS problem
       FROM manifest_v m LEFT JOIN images_v i ON i.object_id = m.object_id AND i.filename = m.filename""",
)
def _(t):
    on_disk = t.images_v.select("object_id", "filename", F.col("sha256").alias("actual"))
    return files.verified_manifest(t.manifest_v, on_disk).select("object_id", "page", "problem")


@query(
    "src07_srt01_natural_order",
    r"""SELECT object_id, filename, row_number() OVER (PARTITION BY object_id ORDER BY page) AS position FROM images_v""",
)
def _(t):
    from ..functions.text import natural_key
    from ..operators.ordered import numbered

    rows = files.page_images(t.images_v.withColumn("path", F.concat("object_id", F.lit("/"), "filename")))
    keyed = rows.select("object_id", "filename", natural_key(F.col("filename")).alias("key"))
    return numbered(keyed, ["object_id"], ["key", "filename"], "position").drop("key")


@query(
    "src08_preferred_folder",
    """SELECT object_id, page, folder FROM (SELECT *, min(priority) OVER (PARTITION BY object_id) AS winner FROM (
         SELECT object_id, page, 2 AS priority, 'processed' AS folder FROM images_v
         UNION ALL SELECT object_id, page, 1, 'supplied' FROM manifest_v WHERE page % 3 = 2)) WHERE priority = winner""",
)
def _(t):
    both = t.images_v.select("object_id", "page", F.lit(2).alias("priority"), F.lit("processed").alias("folder")).unionByName(
        t.manifest_v.filter("page % 3 = 2").select("object_id", "page", F.lit(1).alias("priority"), F.lit("supplied").alias("folder"))
    )
    return files.preferred_folder(both).drop("priority")


@query(
    "agg24_dominant_format",
    "SELECT object_id, CASE WHEN CAST(substr(object_id, 6) AS INT) % 2 = 0 THEN 'jpg' ELSE 'png' END AS format FROM images_v GROUP BY object_id",
)
def _(t):
    return files.dominant_format(t.images_v)


@query(
    "src09_inventory_scan",
    "SELECT 'doc-' || CAST(doc_id AS STRING) AS id, source AS source_type, CAST(doc_id % 9 AS INT) AS pages, doc_id % 2 = 0 AS transcribable FROM documents WHERE doc_id % 13 <> 5",
)
def _(t):
    n = F.col("doc_id")
    record = F.struct(
        F.when(n % 13 != 5, F.concat(F.lit("doc-"), n.cast("string"))).alias("id"), F.col("source").alias("source_type"),
        (n % 9).cast("int").alias("pages"), (n % 2 == 0).alias("transcribable"),
    )
    value = F.to_json(F.struct(F.array(record).alias("documents")))
    return manifests.inventory_rows(t.documents.select(value.alias("value"))).select("id", "source_type", "pages", "transcribable")


@query(
    "src10_remote_image_worklist",
    """SELECT 'page-' || CAST(page_id AS STRING) AS object_id, CAST(p AS INT) AS page, url || '/' || CAST(p AS STRING) AS url
       FROM pages, (VALUES (1), (2)) v(p) WHERE page_id % 3 < 2 OR p = 2""",
)
def _(t):
    n = F.col("page_id")
    first, second = F.concat("url", F.lit("/1")), F.concat("url", F.lit("/2"))
    as_map = F.to_json(F.struct(F.create_map(F.lit("1"), first, F.lit("2"), second).alias("image_urls")))
    as_list = F.to_json(F.struct(F.array(first, second).alias("image_urls")))
    identifier = F.concat(F.lit("page-"), n.cast("string")).alias("object_id")
    declared = t.pages.filter(n % 3 < 2).select(
        identifier, F.parse_json(F.when(n % 3 == 0, as_map).otherwise(as_list)).alias("metadata")
    )
    # one image with several page breaks: the last one in the body counts, those in front of it do not
    markup = F.concat(
        F.lit('<TEI><facsimile><graphic xml:id="a" url="'), F.replace(second, F.lit("&"), F.lit("&amp;")),
        F.lit('"/></facsimile><text><front><pb n="9" facs="#a"/></front><body><pb n="3" facs="#a"/><pb n="2" facs="#a"/></body></text></TEI>'),
    )
    in_markup = t.pages.filter(n % 3 == 2).select(identifier, markup.alias("markup"))
    return manifests.remote_images(declared).unionByName(manifests.remote_images_of_markup(in_markup))


@query(
    "src12_call_records",
    "SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, CAST(doc_id % 5 AS INT) AS chunk, text AS answer, CASE WHEN doc_id % 8 = 1 THEN 'timeout' END AS error FROM documents",
)
def _(t):
    n = F.col("doc_id")
    value = F.to_json(
        F.struct((n % 5).alias("chunk"), F.col("text").alias("answer"), F.when(n % 8 == 1, "timeout").alias("error"))
    )
    rows = t.documents.select(F.concat(F.lit("doc-"), n.cast("string")).alias("object_id"), value.alias("value"))
    return manifests.call_records(rows).select("object_id", "chunk", "answer", "error")


@query(
    "src13_evaluation_fixtures",
    """SELECT 'fx-' || CAST(doc_id AS STRING) AS fixture_id, CASE WHEN doc_id % 2 = 0 THEN 'hsa-strict' ELSE 'zbz-fidelity' END AS profile,
              CASE WHEN doc_id % 3 = 0 THEN 'page 1' ELSE 'all' END AS scope, 'none' AS reference_class, TRUE AS has_hypothesis, doc_id % 4 <> 0 AS has_reference FROM documents""",
)
def _(t):
    n = F.col("doc_id")
    side = F.struct(F.lit("text").alias("kind"), F.lit("x.txt").alias("path"))
    fixture = F.struct(
        F.concat(F.lit("fx-"), n.cast("string")).alias("id"), F.array(F.lit("cer")).alias("checks"),
        F.when(n % 2 == 1, "zbz-fidelity").alias("profile"), F.when(n % 3 == 0, "page 1").alias("scope"),
        side.alias("hypothesis"), F.when(n % 4 != 0, side).alias("reference"),
    )
    value = F.to_json(F.struct(F.lit("m").alias("name"), F.lit("hsa-strict").alias("profile"), F.array(fixture).alias("fixtures")))
    return manifests.evaluation_fixtures(t.documents.select(value.alias("value"))).select(
        "fixture_id", "profile", "scope", "reference_class", "has_hypothesis", "has_reference"
    )


@query(
    "src15_proposals",
    """SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, CASE WHEN doc_id % 6 <> 1 THEN text END AS transcription,
              CASE WHEN doc_id % 6 = 1 THEN 'Unreadable proposal' END AS error FROM documents""",
)
def _(t):
    n = F.col("doc_id")
    value = F.to_json(F.struct(F.col("text").alias("transcription"), F.lit(1).alias("page")))
    rows = t.documents.select(
        F.concat(F.lit("doc-"), n.cast("string")).alias("object_id"), n.cast("string").alias("id"),
        F.when(n % 6 == 1, F.concat(F.lit("{"), value)).otherwise(value).alias("value"),
    )
    return manifests.proposals(rows).select("object_id", "transcription", "error")


@query(
    "src16_annotations",
    """SELECT 'doc-' || CAST(doc_id AS STRING) AS object_id, doc_id % 5 <> 4 AS readable, CASE WHEN doc_id % 5 < 2 THEN sha256(text) END AS binding FROM documents""",
)
def _(t):
    n = F.col("doc_id")
    bound = F.to_json(F.struct(F.struct(F.when(n % 5 < 2, F.sha2("text", 256)).alias("transcription_sha256")).alias("_meta")))
    rows = t.documents.select(
        F.concat(F.lit("doc-"), n.cast("string")).alias("object_id"), F.when(n % 5 == 4, "[1").otherwise(bound).alias("value")
    )
    return manifests.annotations(rows)


@query(
    "job02_extraction_audit",
    """SELECT object_id, count(*) AS pages, count(error) AS failed_pages, CASE WHEN count(error) > 0 THEN 'failed' ELSE 'complete' END AS state FROM manifest_v GROUP BY object_id""",
)
def _(t):
    return inventory.extraction_audit(t.manifest_v)


@query(
    "job02_extraction_skip",
    """SELECT object_id, pages, failed_pages, state, coalesce(state = 'complete' AND n % 3 <> 1 AND n % 4 <> 2, FALSE) AS skip
       FROM (SELECT object_id, count(*) AS pages, count(error) AS failed_pages, CASE WHEN count(error) > 0 THEN 'failed' ELSE 'complete' END AS state,
                    CAST(substr(object_id, 6) AS INT) AS n FROM manifest_v GROUP BY object_id)
       UNION ALL SELECT 'new-' || CAST(doc_id AS STRING), NULL, NULL, NULL, FALSE FROM documents""",
)
def _(t):
    # sources that changed, sources that are wanted at another resolution, and sources without a manifest
    number = F.substring("object_id", 6, 20).cast("int")
    manifest = t.manifest_v.withColumns({"recorded_sha256": F.sha2("object_id", 256), "dpi": F.lit(300)})
    known = t.manifest_v.select("object_id").distinct().select(
        "object_id", F.when(number % 3 == 1, "changed").otherwise(F.sha2("object_id", 256)).alias("source_sha256"), F.when(number % 4 == 2, 400).otherwise(300).alias("wanted_dpi")
    )
    new = t.documents.select(F.concat(F.lit("new-"), F.col("doc_id").cast("string")).alias("object_id"), F.lit("x").alias("source_sha256"), F.lit(300).alias("wanted_dpi"))
    return inventory.extraction_audit(manifest, known.unionByName(new)).select("object_id", "pages", "failed_pages", "state", "skip")


@query(
    "job03_join13_fetch_plan",
    """SELECT w.object_id, w.page, w.url, CASE WHEN w.page % 5 = 4 AND i.filename IS NOT NULL THEN 'ambiguous'
              WHEN m.url = w.url AND m.filename = i.filename AND m.sha256 = i.sha256 THEN 'current' ELSE 'fetch' END AS state
       FROM (SELECT object_id, page, url FROM manifest_v WHERE starts_with(url, 'http')) w
       LEFT JOIN images_v i ON i.object_id = w.object_id AND i.page = w.page LEFT JOIN manifest_v m ON m.object_id = w.object_id AND m.page = w.page""",
)
def _(t):
    worklist = inventory.safe_worklist(t.manifest_v.select("object_id", "page", "url"))
    twice = t.images_v.filter("page % 5 = 4").withColumn("filename", F.concat("filename", F.lit(".tif")))
    return inventory.fetch_plan(worklist, t.manifest_v, t.images_v.unionByName(twice))


@query(
    "join04_url_differences",
    """SELECT object_id, page, i.url AS declared_url, m.url AS recorded_url FROM images_v i FULL JOIN manifest_v m USING (object_id, page) WHERE i.url IS DISTINCT FROM m.url""",
)
def _(t):
    return inventory.url_differences(t.images_v, t.manifest_v)


@query(
    "join16_stale_files",
    """SELECT object_id, filename FROM images_v i WHERE NOT EXISTS (SELECT 1 FROM manifest_v m WHERE m.object_id = i.object_id AND m.filename = i.filename)""",
)
def _(t):
    return inventory.stale_files(t.images_v, t.manifest_v, t.manifest_v).select("object_id", "filename")


@query(
    "job03_nonconsecutive_pages",
    "SELECT object_id FROM images_v GROUP BY object_id HAVING NOT (min(page) = 1 AND max(page) = count(*))",
)
def _(t):
    return inventory.nonconsecutive_worklists(t.images_v)


@query(
    "fp05_image_digest",
    """SELECT object_id, substr(sha256(CAST(count(*) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS STRING)
              || chr(31) || CAST(sum(CAST('0x' || substr(h, 31, 15) AS BIGINT)) AS STRING) || chr(31) || CAST(sum(CAST('0x' || substr(h, 46, 15) AS BIGINT)) AS STRING)), 1, 12) AS images_hash
       FROM (SELECT object_id, sha256(CAST(page AS STRING) || chr(31) || filename || chr(31) || sha256) AS h FROM images_v) GROUP BY object_id""",
)
def _(t):
    from ..operators import fingerprints

    return fingerprints.image_digest(t.images_v)


@query("gate13_image_states", "SELECT object_id, count(*) AS states FROM images_v GROUP BY object_id HAVING min(page) = 1 AND max(page) = count(*)")
def _(t):
    bad = contract.page_number_violations(t.images_v)
    counted = t.images_v.groupBy("object_id").agg(F.count(F.lit(1)).alias("states"))
    return counted.join(bad.select("object_id"), "object_id", "left_anti")
