"""Writing pages as WARC archives and reading archives back by a verified chain of records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark.llm.text import row_key
from riskspark.session import cut_lineage, scratch_path

MAGIC, HEADER_END = re.compile(rb"WARC/1\.[01]\r\n"), re.compile(rb"(?=\r\n\r\n)")
#: Most records in an archive, and most bytes of an archive of several records; one task reads a whole archive, so this bounds its memory.
RECORDS_PER_ARCHIVE, ARCHIVE_BYTES = 512, 64 << 20
_RECORD_URN = "urn:page:"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of 20 bytes given in hexadecimal: 5 hexadecimal digits are 4 letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(bits, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*out)


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write one record per row below ``path`` as gzipped archives.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is a response; the others
    become revisit records, which name it and carry no payload. Only ids and digests are grouped, with partial
    aggregation; payloads move once, to their archive. Records of about one size (a power of two) share archives, as many as
    ARCHIVE_BYTES hold; a larger one has an archive to itself.

    A NULL payload is empty, a NULL url an empty one. A NULL id has no name and comes behind all ids: its row revisits a
    named row of equal payload; where there is none it is a response. Repeated rows are records of their own, all responses or all
    revisits; rows that share an id need not be equal.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.regexp_replace(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), r"[\r\n]+", " ").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", row_key(F.col("id"), F.col("payload")))
    digests = rows.select("id", "key", F.octet_length("payload").alias("bytes"), F.sha2("payload", 256).alias("same")).where(F.col("bytes") >= min_bytes)
    firsts = cut_lineage(digests.groupBy("same").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n"), "warc-firsts")
    revisits = digests.join(firsts, "same").where("not id <=> first").select("key", "first").distinct()

    head = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("first").isNull(), "response").otherwise("revisit")),
        F.concat(F.lit(f"WARC-Record-ID: <{_RECORD_URN}"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.lit("WARC-Date: 2000-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.sha1("payload"))),
        F.when(F.col("first").isNotNull(), F.concat(F.lit(f"WARC-Refers-To: <{_RECORD_URN}"), F.col("first").cast("string"), F.lit(">"))),
        F.when(F.col("first").isNotNull(), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("Content-Length: "), F.octet_length("body").cast("string")),
    ]
    # A revisit may come from a large payload; its class follows the payload all the same, which only makes its archive smaller.
    width = F.octet_length("payload") + F.octet_length("url")
    kind = size_class(width)
    classes = sorted(r["size"] for r in rows.select(kind.alias("size")).distinct().collect())
    records = rows.join(revisits, "key", "left").withColumn("body", F.when(F.col("first").isNull(), F.col("payload")).otherwise(""))
    # The text writer adds the last line feed of the two line ends that close a record.
    value = F.concat(F.concat_ws("\r\n", *head), F.lit("\r\n\r\n"), F.col("body"), F.lit("\r\n\r"))
    for size in classes:
        writer = records.where(kind == size).select(value.alias("value")).write.option("compression", "gzip")
        writer.option("maxRecordsPerFile", max(1, min(RECORDS_PER_ARCHIVE, ARCHIVE_BYTES >> size))).text(f"{path}/size-{size}")
    if not classes:
        records.select(value.alias("value")).write.text(f"{path}/size-0")


def size_class(width: Column) -> Column:
    """The least power of two, as an exponent, that holds a record of ``width`` bytes; small ones are one class."""
    small = (ARCHIVE_BYTES // RECORDS_PER_ARCHIVE).bit_length() - 1
    return F.greatest(F.ceil(F.log2(width + 1_024)), F.lit(small)).cast("int")


_CANDIDATE = "path string, at long, next long, type string, id string, refers_to string, digest string, payload_bytes long, payload_digest string"


def _candidates(batches):
    """Every place in an archive that looks like a record, with the place after it and what it would hold."""
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string()]
    names = [f.split()[0] for f in _CANDIDATE.split(", ")]
    for batch in batches:
        out = []
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = content.as_buffer().to_pybytes()
            if data[:2] == b"\x1f\x8b":
                data = gzip.decompress(data)
            ends = [m.start() for m in HEADER_END.finditer(data)]
            for m in MAGIC.finditer(data):
                after = bisect_left(ends, m.start())
                if after == len(ends):
                    continue
                end = ends[after]
                fields = {}
                for line in data[m.end() : end].decode("utf-8", "replace").split("\r\n"):
                    name, _, value = line.partition(":")
                    fields[name.strip().lower()] = value.strip()
                length = fields.get("content-length", "")
                body = end + 4
                if not (length.isascii() and length.isdigit()) or data[body + int(length) : body + int(length) + 4] != b"\r\n\r\n":
                    continue
                payload = memoryview(data)[body : body + int(length)]
                urn = lambda key: fields[key].strip("<>").removeprefix(_RECORD_URN) or None if key in fields else None
                sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                out.append((path, m.start(), body + int(length) + 4, fields.get("warc-type"), urn("warc-record-id"), urn("warc-refers-to"), digest, int(length), sha1))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``: (path, at, next, type, id, refers_to, digest, payload_bytes, payload_digest).

    Tasks list candidates of whole archives (each at most what one row can hold, 2 GB). A candidate counts if the chain
    of records from its archive's start reaches it: in every round the reached set takes in what its members'
    pointers reach, and all pointers double their range, so that n records take log2(n) rounds of joins, which are
    dealt by archive and place and never broadcast. What looks like a record inside a payload is never reached. A damaged archive ends at the damage. No archive, no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("path", "content")
    found = cut_lineage(files.mapInArrow(_candidates, _CANDIDATE), "warc-candidates")
    jump = found.select("path", "at", "next")
    reached = found.where("at = 0").select("path", "at")
    rounds = found.groupBy("path").count().agg(F.max("count")).first()[0] or 0
    for _ in range(int(rounds).bit_length()):
        reached = cut_lineage(reached.unionByName(reached.join(jump.hint("merge"), ["path", "at"]).select("path", F.col("next").alias("at"))).distinct(), "warc-reached")
        further = jump.select("path", F.col("at").alias("next"), F.col("next").alias("beyond"))
        jump = cut_lineage(jump.join(further.hint("merge"), ["path", "next"]).select("path", "at", F.col("beyond").alias("next")), "warc-jump")
    return found.join(reached.hint("merge"), ["path", "at"], "left_semi")


def resolve(records: DataFrame) -> DataFrame:
    """Give revisit records the length and digest of the payload that they refer to, and check every digest.

    Returns (id, payload_bytes, payload_digest, record_type, refers_to). A response whose payload does not have
    the digest in its header is dropped as damaged, and so are its revisits.
    """
    sound = cut_lineage(records.where("type = 'response' and digest = payload_digest").select("id", "payload_bytes", "payload_digest"), "warc-sound")
    seen = records.where("type = 'revisit'").select("id", "refers_to", "digest")
    # Repeated rows are several responses of one name.
    original = sound.select(F.col("id").alias("refers_to"), "payload_bytes", F.col("payload_digest").alias("digest")).distinct()
    again = seen.join(original, ["refers_to", "digest"]).select("id", "payload_bytes", F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to")
    return sound.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to")).unionByName(again)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path, min_bytes)
    return resolve(read_warc(pages.sparkSession, path))
