"""Write landed documents (feed XML, NVD pages, KEV catalogs, EPSS pages) from domain
tables — the inverse of the scanners, used to exercise them end to end on data Spark
derives from the test tables, and to replay history into a landing folder.

Pages are formed by key ranges (``key div page_size``), so a page never holds more than
``page_size`` rows however large the table is; each page is one JSON document per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threatlake.schemas import KEV_FIELDS

PAGE_SIZE = 2000


def write_feed_xml(items: DataFrame, path: str, page_size: int = PAGE_SIZE) -> None:
    """Feed items -> Atom documents ``path/feed_url=<feed>/part-*.xml`` (``<feed>`` root,
    one ``<entry>`` per item: id, title, link href, published, summary, content,
    category terms)."""
    atom = items.select(
        "feed_url", "title", F.col("guid").alias("id"),
        F.array(F.struct(F.col("link").alias("_href"), F.lit("alternate").alias("_rel"))).alias("link"),
        F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"),
        "summary", "content",
        F.transform("categories", lambda c: F.struct(c.alias("_term"))).alias("category"))
    # documents are capped at ``page_size`` entries, so a feed holding a third of all items
    # still lands as many bounded documents, like a real feed's successive fetches
    (atom.repartition("feed_url").write.mode("overwrite").format("xml")
     .option("rootTag", "feed").option("rowTag", "entry").option("maxRecordsPerFile", page_size)
     .partitionBy("feed_url").save(path))


def write_nvd_pages(cve: DataFrame, path: str, key, page_size: int = PAGE_SIZE) -> None:
    """NVD rows -> API-shaped pages; ``lastModified`` is put into each CVE object."""
    nvd = cve.where(F.col("source") == "NVD").select(
        (key / page_size).cast("long").alias("page"),
        F.concat(F.lit('{"cve":{"lastModified":"'), F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss"),
                 F.lit('",'), F.substr("json", F.lit(2)), F.lit("}")).alias("v"))
    total = cve.where(F.col("source") == "NVD").select(F.count(F.lit(1))).scalar()
    pages = nvd.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.collect_list("v").alias("vs"))
    doc = F.concat(F.lit('{"resultsPerPage":'), F.col("n").cast("string"),
                   F.lit(',"startIndex":'), (F.col("page") * page_size).cast("string"),
                   F.lit(',"totalResults":'), total.cast("string"),
                   F.lit(',"vulnerabilities":['), F.array_join("vs", ","), F.lit("]}"))
    pages.select(doc.alias("value")).write.mode("overwrite").text(path)


def write_kev_catalogs(kev: DataFrame, path: str, key, released: str, page_size: int = PAGE_SIZE) -> None:
    """KEV rows (JSON projected to the nine catalog fields) -> catalog documents."""
    entry = F.struct(F.col("cve_id").alias("cveID"),
                     *[F.get_json_object("json", f"$.{f}").alias(f) for f in KEV_FIELDS[1:]])
    pages = kev.where(F.col("source") == "CISA-KEV").groupBy((key / page_size).cast("long").alias("page")) \
        .agg(F.count(F.lit(1)).alias("count"), F.collect_list(entry).alias("vulnerabilities"))
    doc = F.to_json(F.struct(F.lit("Known exploited vulnerabilities").alias("title"),
                             F.lit(released[:10].replace("-", ".")).alias("catalogVersion"),
                             F.lit(released).alias("dateReleased"), "count", "vulnerabilities"),
                    {"ignoreNullFields": "false"})
    pages.select(doc.alias("value")).write.mode("overwrite").text(path)


def write_epss_pages(epss: DataFrame, path: str, key, page_size: int = PAGE_SIZE) -> None:
    """Daily rows -> ``path/as_of=<day>/`` pages with text scores, as the API sends them."""
    day_total = epss.groupBy("as_of").agg(F.count(F.lit(1)).alias("total"))
    rows = epss.select("as_of", (key / page_size).cast("long").alias("page"),
                       F.struct(F.col("cve_id").alias("cve"), F.col("epss").cast("string").alias("epss"),
                                F.col("percentile").cast("string").alias("percentile"),
                                F.col("as_of").cast("string").alias("date")).alias("d"))
    pages = rows.groupBy("as_of", "page").agg(F.collect_list("d").alias("data")).join(day_total, "as_of")
    doc = F.to_json(F.struct(F.lit("OK").alias("status"), "total",
                             (F.col("page") * page_size).alias("offset"), F.lit(page_size).alias("limit"), "data"))
    pages.select("as_of", doc.alias("value")).write.mode("overwrite").partitionBy("as_of").text(path)


def _element(name: str, c) -> "F.Column":
    """``<name>text</name>``, nothing for null."""
    text = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.coalesce(F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>")), F.lit(""))


# Kind -> (what comes before a document's items, after them)
_FRAMES = {
    "rss": ('<?xml version="1.0" encoding="UTF-8"?>\n<rss xmlns:content="urn:c" version="2.0"><channel><title>f</title>', "</channel></rss>"),
    "rdf": ('<rdf:RDF xmlns:rdf="urn:r" xmlns:content="urn:c" xmlns:dc="urn:d"><channel><title>f</title></channel>', "</rdf:RDF>"),
    "atom": ('<?xml version="1.0"?><!-- landed --><feed xmlns="urn:a"><title>f</title>', "</feed>"),
}


def write_feed_documents(items: DataFrame, path: str, kind, page, broken=None) -> None:
    """Items -> one document per feed and ``page``, a file of its own in ``path/feed=<feed>--all/``, of the
    kind that the expression ``kind`` names; documents with ``broken`` end in the middle. Files of one
    feed share a folder: one each would be listed, made and committed for every document."""
    when = F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    common = [_element("title", F.col("title"))]
    forms = {
        "rss": F.concat(F.lit("<item>"), *common, _element("link", F.col("link")), _element("guid", F.col("guid")), _element("pubDate", when),
                        _element("description", F.col("summary")), _element("content:encoded", F.col("content")), F.lit("</item>")),
        "rdf": F.concat(F.lit("<item>"), *common, _element("link", F.col("link")), _element("guid", F.col("guid")), _element("dc:date", when),
                        _element("description", F.col("summary")), _element("content:encoded", F.col("content")), F.lit("</item>")),
        "atom": F.concat(F.lit("<entry>"), *common, F.coalesce(F.concat(F.lit('<link href="'), F.col("link"), F.lit('"/>')), F.lit("")),
                         _element("id", F.col("guid")), _element("published", when), _element("summary", F.col("summary")),
                         _element("content", F.col("content")), F.lit("</entry>"))}
    pick = lambda values: F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in values.items()])
    folder = F.concat_ws("--", "feed_url", F.when(page.isNotNull(), "all"))
    rows = items.withColumn("kind", kind).select(F.concat_ws("--", "feed_url", page.cast("string")).alias("feed"), folder.alias("folder"), "kind",
                                                 (broken if broken is not None else F.lit(False)).alias("broken"), pick(forms).alias("item"))
    docs = rows.groupBy("feed", "kind").agg(F.min("folder").alias("folder"), F.max("broken").alias("broken"), F.array_join(F.collect_list("item"), "").alias("body"))
    text = F.concat(pick({k: F.lit(a) for k, (a, _) in _FRAMES.items()}), "body", pick({k: F.lit(b) for k, (_, b) in _FRAMES.items()}))
    cut = F.when(F.col("broken"), F.substr(text, F.lit(1), F.greatest(F.floor(F.length(text) / 2).cast("int"), F.lit(120)))).otherwise(text)
    write_documents(docs.select(F.col("folder").alias("feed"), cut.alias("value")), path)


def write_documents(docs: DataFrame, path: str) -> None:
    """(feed, value) -> one file per row in ``path/feed=<feed>/``; tasks move their files into place."""
    (docs.write.mode("append").option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2)
     .partitionBy("feed").text(path))
