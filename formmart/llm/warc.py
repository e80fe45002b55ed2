"""WARC archives: write records with an index first, read them back by coalesced byte ranges.

Writing.  Records of at least ``min_revisit`` payload bytes with equal payloads
form a group: the one with the largest id is a ``response``, the others are
``revisit`` records without a payload that refer to it.  Smaller records are
always responses.  Every record is its own gzip member, so any record can be
read alone.  Each task writes files of its own, whose names hold the task
attempt; the index (file, offset, length, URL, digest, type) holds only files of
the attempts that counted, and files of lost attempts are deleted afterwards.

Reading.  The wanted index rows are sorted by file and offset, neighbours at
most ``max_gap`` bytes apart are merged into one range read of at most
``max_range`` bytes (a larger record is one read), and each record is unpacked
and, where it holds a payload, checked against its digest.

Paths are opened with pyarrow's file systems (local, HDFS, object stores).

Edge cases: a null payload is empty; a null id takes part as a revisit of its
group's largest id (a group of only null ids stays responses); rows that repeat
the largest id of their group are all responses.  Control characters of a URL
are percent-encoded in the record's header; the index keeps the URL as it is.
A payload of any length is one record, held in memory once; an empty table gives
an empty index; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formmart.llm.common import written
from formmart.session import scratch_path

RECORD_DATE = "2024-01-01T00:00:00Z"
INDEX_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("record_id", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()),
])
RECORD_SCHEMA = T.StructType(INDEX_SCHEMA.fields + [T.StructField("payload", T.BinaryType())])
_ARROW = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, _ARROW[f.dataType]) for f in schema.fields])


def _urn(record_id: int | None) -> str:
    return f"<urn:x-record:{'null' if record_id is None else record_id}>"


def _from_urn(urn: str | None) -> int | None:
    tail = urn[1:-1].rpartition(":")[2] if urn else "null"
    return None if tail == "null" else int(tail)


def encode_record(record_id, url, payload: bytes, digest: str, refers_to, date: str = RECORD_DATE,
                  level: int = 4) -> bytes:
    """One gzip member: a response, or a revisit when ``refers_to`` is given."""
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
            "\r\n\r\n").encode()
    body = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(record_id)),
              ("WARC-Date", date), ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
              ("Content-Length", str(len(body)))]
    if url is not None:
        safe = "".join(quote(c) if ord(c) < 33 or ord(c) == 127 else c for c in url)
        fields.append(("WARC-Target-URI", safe))
    if revisit:
        fields += [("WARC-Refers-To", _urn(refers_to)),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + body + b"\r\n\r\n") + packer.flush()


def decode_record(member: bytes) -> dict:
    """Header fields and payload of one gzip member; raises on a damaged record."""
    plain = zlib.decompress(member, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("the record's length doesn't fit its content")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    return {"record_id": _from_urn(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
            "payload_digest": digest, "payload_bytes": size,
            "refers_to": _from_urn(fields.get("WARC-Refers-To")), "payload": None if revisit else payload}


def with_revisits(df: DataFrame, record_id: str, url: str, payload: str, min_revisit: int = 1000) -> DataFrame:
    """Columns record_id, url, payload (binary), payload_digest, refers_to (null: a response)."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.select(F.col(record_id).cast("long").alias("record_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload"))
    large = F.octet_length("payload") >= min_revisit
    # only groups of two or more: a row for each, however large the group
    groups = (rows.where(large).groupBy(F.col("payload_digest").alias("key"))
              .agg(F.max("record_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("key", "keeper"))
    # small records match nothing and get keys of their own, so that equal ones don't meet in one task;
    # large groups are split by the adaptive skew join
    own = F.concat(F.lit("small "), F.xxhash64("record_id", "url").cast("string"))
    joined = (rows.withColumn("key", F.when(large, F.col("payload_digest")).otherwise(own))
              .join(groups, "key", "left"))
    refers = F.when(~F.col("record_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return joined.select("record_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def write_archives(df: DataFrame, record_id: str, url: str, payload: str, out_dir: str | None = None,
                   min_revisit: int = 1000, max_file_bytes: int = 1 << 30) -> DataFrame:
    """Write the archives below ``out_dir`` (the shared folder where none is given); the index, stored."""
    out_dir = out_dir or scratch_path(df.sparkSession, "llm", "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(out_dir)
        fs.create_dir(base, recursive=True)
        sink, name, offset, files = None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for rid, link, body, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                    if sink is None or offset >= max_file_bytes:
                        if sink:
                            sink.close()
                        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{files}.warc.gz"
                        sink, offset, files = fs.open_output_stream(f"{base}/{name}", compression=None), 0, files + 1
                    member = encode_record(rid, link, body, digest, refers)
                    sink.write(member)
                    rows.append((f"{out_dir}/{name}", offset, len(member), rid, link, digest, len(body),
                                 "response" if refers is None else "revisit", refers))
                    offset += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), _arrow(INDEX_SCHEMA).types)],
                        schema=_arrow(INDEX_SCHEMA))
        finally:
            if sink:
                sink.close()

    index = written(with_revisits(df, record_id, url, payload, min_revisit).mapInArrow(write, INDEX_SCHEMA), "warc_index")
    _drop_lost_attempts(index, out_dir)
    return index


def _drop_lost_attempts(index: DataFrame, out_dir: str) -> None:
    """Delete files that no index row names (one name for each file comes to the driver)."""
    fs, base = pafs.FileSystem.from_uri(out_dir)
    known = {r.file.rpartition("/")[2] for r in index.select("file").distinct().toLocalIterator()}
    for info in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
        if info.type == pafs.FileType.File and info.base_name not in known:
            fs.delete_file(info.path)


def read_records(index: DataFrame, max_gap: int = 64 << 10, max_range: int = 8 << 20,
                 with_payload: bool = True) -> DataFrame:
    """The records of the given index rows (any selection of them), one output row for each."""
    schema = _arrow(RECORD_SCHEMA)

    def ranges(rows: Iterator[dict]) -> Iterator[list[dict]]:
        run: list[dict] = []
        for row in rows:
            if run and (row["file"] != run[-1]["file"]
                        or row["offset"] - run[-1]["offset"] - run[-1]["length"] > max_gap
                        or row["offset"] + row["length"] - run[0]["offset"] > max_range):
                yield run
                run = []
            run.append(row)
        if run:
            yield run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, opened = None, None
        try:
            for run in ranges(r for b in batches for r in b.to_pylist()):
                if opened != run[0]["file"]:
                    if source:
                        source.close()
                    opened = run[0]["file"]
                    fs, path = pafs.FileSystem.from_uri(opened)
                    source = fs.open_input_file(path)
                start = run[0]["offset"]
                data = source.read_at(max(r["offset"] + r["length"] for r in run) - start, start)
                out = []
                for row in run:
                    at = row["offset"] - start
                    record = decode_record(data[at:at + row["length"]])
                    if not with_payload:
                        record["payload"] = None
                    out.append(row | record)
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        finally:
            if source:
                source.close()

    ordered = (index.select(*INDEX_SCHEMA.names).repartitionByRange("file", "offset")
               .sortWithinPartitions("file", "offset"))
    return ordered.mapInArrow(read, RECORD_SCHEMA)
