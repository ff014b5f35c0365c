"""Merkle fixity audit of WARC archives.

Pages are serialised as WARC records and laid into archives one after
another; a record is named by its archive, offset and length.  For each replica a hash
tree is built: leaves are SHA-256 digests of the records' bytes, a node of
level l covers an ordered range of ``FANOUT`` ** l records and hashes its
children's offset ranges and digests in order, up to one root per archive.

The audit compares the roots of two replicas, then, level by level, only the
children of nodes that differ, down to the records: their offset ranges locate the
damage.  Trees are Parquet tables made by one aggregate per level whose
groups hold at most ``FANOUT`` rows; they are kept, so a later audit reads
no record.

Records that the descent leaves are matched by identity (page id and url), not by place:
equal ones are sound, wherever they lie.  A lost, added or resized record moves all that
follow in its archive, so those are compared as records, at most one archive's.

A null url or html is written as empty.  Page ids may be null or repeat: records
are ordered by page id, url and digest, so replicas with the same records
have the same trees.  Records without a page id are dealt to archives by their url,
those without either by their bytes: no archive takes them all, and of the last kind a damaged one
may count as ``missing`` and ``extra``, having no identity but its bytes.  A record of one replica only is reported as ``missing`` (from the
second) or ``extra``; one of both with other bytes, of any length, as ``corrupt``.  Equal
tables give an empty audit, as do empty ones.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import settle

FANOUT = 16
ARCHIVE_BYTES = 16 << 20


def warc_record(page_id: str = "page_id", url: str = "url", html: str = "html") -> Column:
    """A WARC 1.0 resource record as text (its UTF-8 bytes are the record)."""
    body = F.coalesce(F.col(html), F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
                    F.coalesce(F.col(url), F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def archive_of(key: str, archives: int) -> Column:
    """Archive number: records are dealt evenly by the hash (hexadecimal) in ``key``."""
    return F.conv(key, 16, 10).cast("long") % archives


def record_hashes(pages: DataFrame, record: Column) -> DataFrame:
    """(page_id, url_key, length, digest, archive_key) of each record, in one pass over the bytes."""
    digest = F.sha2("__record", 256)
    key = F.coalesce(F.col("page_id").cast("string"), F.concat(F.lit("url:"), F.col("url")), F.concat(F.lit("sha256:"), digest))
    return (pages.withColumn("__record", record.cast("binary"))
            .select("page_id", F.xxhash64("url").alias("url_key"), F.octet_length("__record").cast("long").alias("length"),
                    digest.alias("digest"), F.substring(F.md5(key.cast("binary")), 1, 8).alias("archive_key")))


def lay_out(hashes: DataFrame, archives: int) -> DataFrame:
    """Leaves (level 0): archive, index, start, end, digest, page_id, url_key."""
    order = Window.partitionBy("archive").orderBy("page_id", "url_key", "digest")
    end = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (hashes.withColumn("archive", archive_of("archive_key", archives)).withColumn("end", end)
            .select(F.lit(0).alias("level"), "archive", (F.row_number().over(order) - 1).cast("long").alias("index"),
                    (F.col("end") - F.col("length")).alias("start"), "end", "digest", "page_id", "url_key"))


def merkle_tree(leaves: DataFrame) -> list[DataFrame]:
    """The levels of the tree, leaves first; the last has one node per archive."""
    levels = [settle(leaves)]
    while (levels[-1].agg(F.max("index")).first()[0] or 0) > 0:
        child = F.struct("index", "start", "end", "digest")
        text = F.concat_ws("\n", F.transform("kids", lambda k: F.concat_ws(":", k["start"] - F.col("start"), k["end"] - F.col("start"), k["digest"])))
        grouped = (levels[-1].groupBy("archive", F.floor(F.col("index") / FANOUT).alias("index"))
                   .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sort_array(F.collect_list(child)).alias("kids")))
        levels.append(settle(grouped.select(F.lit(len(levels)).alias("level"), "archive", "index", "start", "end",
                                            F.sha2(text.cast("binary"), 256).alias("digest"))))
    return levels


def audit(first: list[DataFrame], second: list[DataFrame]) -> DataFrame:
    """(archive, start, length, page_id, status, first_sha256, second_sha256) of every record that differs."""
    height = max(len(first), len(second))
    suspects = None
    for level in range(height - 1, -1, -1):
        a, b = (_side(tree, level, name) for tree, name in ((first, "a"), (second, "b")))
        if suspects is not None:
            a, b = (x.withColumn("parent", F.floor(F.col("index") / FANOUT)).join(suspects, ["archive", "parent"], "left_semi").drop("parent")
                    for x in (a, b))
        both = a.join(b, ["archive", "index"], "full")
        differ = settle(both.where(~(F.col("a_digest").eqNullSafe(F.col("b_digest"))
                                     & F.col("a_start").eqNullSafe(F.col("b_start"))
                                     & F.col("a_end").eqNullSafe(F.col("b_end")))))
        suspects = differ.select("archive", F.col("index").alias("parent"))
    differ = _matched(*(differ.where(f"{x}_digest is not null").select("archive", *[f"{x}_{c}" for c in _RECORD]) for x in "ab"))
    status = (F.when(F.col("b_digest").isNull(), "missing").when(F.col("a_digest").isNull(), "extra").otherwise("corrupt"))
    start, end = F.coalesce("a_start", "b_start"), F.coalesce("a_end", "b_end")
    return differ.select("archive", start.alias("start"), (end - start).alias("length"), F.coalesce("a_page_id", "b_page_id").alias("page_id"),
                         status.alias("status"), F.col("a_digest").alias("first_sha256"), F.col("b_digest").alias("second_sha256"))


_RECORD = ("start", "end", "digest", "page_id", "url_key")


def _matched(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records of both sides joined by identity, without those whose bytes are equal.
    Copies of an identity are matched by equal digests first, then in their order."""
    for same in (["page_id", "url_key", "digest"], ["page_id", "url_key"]):
        sides = []
        for name, side in (("a", a), ("b", b)):
            keys = [F.col(f"{name}_{c}") for c in same]
            nth = F.row_number().over(Window.partitionBy("archive", *keys).orderBy(f"{name}_start"))
            sides.append(side.withColumn(f"{name}_nth", nth).withColumnRenamed("archive", f"{name}_archive"))
        on = [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in ("archive", *same, "nth")]
        both = sides[0].join(sides[1], on, "full").withColumn("archive", F.coalesce("a_archive", "b_archive"))
        if "digest" in same:
            odd = settle(both.where("a_digest is null or b_digest is null"))
            a, b = (odd.where(f"{x}_digest is not null").select("archive", *[f"{x}_{c}" for c in _RECORD]) for x in "ab")
    return both


def _side(tree: list[DataFrame], level: int, name: str) -> DataFrame:
    """A level of a tree with prefixed columns; a tree that is lower has none of it."""
    rows = tree[level] if level < len(tree) else tree[-1].where("false")
    page, url = (F.col(c) if level == 0 else F.lit(None).cast("long") for c in ("page_id", "url_key"))
    return rows.select("archive", "index", F.col("start").alias(f"{name}_start"), F.col("end").alias(f"{name}_end"),
                       F.col("digest").alias(f"{name}_digest"), page.alias(f"{name}_page_id"), url.alias(f"{name}_url_key"))


def archives_for(hashes: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> int:
    total = hashes.agg(F.sum("length")).first()[0] or 0
    return max(1, -(-total // archive_bytes))


def audit_replicas(first: DataFrame, second: DataFrame, archives: int | None = None) -> DataFrame:
    """Audit two replicas' record hashes (``record_hashes``)."""
    first, second = settle(first), settle(second)
    archives = archives or archives_for(first)
    return audit(merkle_tree(lay_out(first, archives)), merkle_tree(lay_out(second, archives)))
