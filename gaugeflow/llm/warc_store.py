"""Content-addressed WARC archive.

Payload bytes are stored once, keyed by SHA-256; the exact header bytes of
every record (WARC header plus HTTP head) are stored apart with that key, and
the original records come back through a join of the two. Reading verifies:
the stored payload must hash to its key, and its SHA-1 must be the one in the
header; otherwise the read fails.

Of records with equal payloads of at least ``min_bytes`` bytes the one with
the smallest page_id is a ``response`` and the others are ``revisit`` records
that refer to it; smaller payloads are all ``response`` records.

Scale: html crosses the network once to be written and once to be read, both
times by digest. Copies are combined in each input split before they are
written, so a payload that a third of the pages share arrives once per split;
it is one row of the payload table, its many headers are narrow and their join
is split by AQE. What a revisit refers to is read back from its
``WARC-Refers-To`` header, joined with the record ids on narrow rows.

Defined cases: null html is an empty payload; null url gives a record without
target; line breaks in a url are percent-encoded in the header; rows that
repeat both page_id and payload of a response are responses themselves; null
page_ids come after all others; a page_id that repeats with other payloads has one record id.
Payloads may be as long as a row; an empty table gives no records. Only
page_id, url and html are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"  # the pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four base32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def header_bytes(revisit: Column) -> Column:
    """WARC header and HTTP head from ``page_id, url, bytes, sha1, owner``."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(CRLF),
        _line("WARC-Record-ID", record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", record_id(F.col("owner"))), _line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit(CRLF),
        http,
    )
    return head.cast("binary")


def write_archive(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Writes ``(headers, payloads)``, both as tables in the shared folder.

    headers: ``page_id, digest, revisit, header``; payloads: ``digest, payload``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    narrow = materialize(
        records.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1")),
        "warc-digests",
    )
    owners = materialize(narrow.groupBy("digest").agg(F.min("page_id").alias("owner")), "warc-owners")
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("owner"))
    headers = narrow.join(owners, "digest").select(
        "page_id", "digest", F.coalesce(revisit, F.lit(False)).alias("revisit"), header_bytes(revisit).alias("header")
    )
    # One aggregate by digest: copies meet in their split first, the rest in one exchange.
    payloads = records.groupBy("digest").agg(F.any_value("payload").alias("payload"))
    return materialize(headers, "warc-headers"), materialize(payloads, "warc-payloads")


def read_records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """``page_id, revisit, header, payload, record``: the exact record, its
    payload verified against the key and the header's digest. ``record`` of a
    revisit has no payload, as written; ``payload`` is always the full one."""
    checked = payloads.withColumn(
        "payload", F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("binary"))
    )
    joined = headers.join(checked, "digest", "left")
    body = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("page_id", "revisit", "header", "payload", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"))


def _field(name: str) -> Column:
    head = F.split_part(F.col("header").cast("string"), F.lit(CRLF * 2), F.lit(1))
    return F.nullif(F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)", 1), F.lit(""))


def parsed(records: DataFrame, headers: DataFrame) -> DataFrame:
    """Header fields of each record, the digest of its full payload, and the page
    that a revisit refers to, found by the record id in its header. A reference
    to a record that is not there is an error."""
    own = base32_sha1(F.col("payload"))
    right = _field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), own)
    fields = records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(right, own).otherwise(F.raise_error(F.lit("payload does not match its header")).cast("string")).alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Refers-To").alias("refers_id"),
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Target-URI").alias("target_uri"),
        F.octet_length("record").cast("long").alias("record_bytes"),
    )
    # Narrow rows, written once: the join below then has plain scans on both sides.
    fields = materialize(fields, "warc-fields")
    pages = headers.where("NOT revisit").select(_field("WARC-Record-ID").alias("refers_id"), F.col("page_id").alias("refers_to"), F.lit(True).alias("there")).distinct()
    found = fields.join(materialize(pages, "warc-record-ids"), "refers_id", "left")
    lost = F.col("refers_id").isNotNull() & F.col("there").isNull()
    refers_to = F.when(lost, F.raise_error(F.concat(F.lit("no such record: "), "refers_id"))).otherwise(F.col("refers_to"))
    return found.withColumn("refers_to", refers_to.cast(fields.schema["page_id"].dataType)).select(*[c for c in fields.columns if c != "refers_id"], "refers_to")
