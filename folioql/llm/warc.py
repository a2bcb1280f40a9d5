"""WARC writing and reading with boundary-chain verification (operator 1).

Writing: a record a page as text, joined by Spark's text writer with the record separator, so the
archives are plain WARC files in any store Spark writes to.  Reading: archives are split anywhere;
each task reads runs between magic lines and emits every candidate record with the offset of its
successor (header plus content length).  Within a split, candidates are chained to the first offset
beyond it; over splits, pointer jumping from the file's start doubles the reach each round.  Only
records on the chain from the start are kept, so magic lines and whole records inside payloads are
never taken for records; payloads that hold magic are put together from their pieces afterwards.

Of pages with equal payloads of at least `REVISIT_FROM` bytes the smallest id is written in full
(rows that share this id all are), the others as revisits without a body.

Edge cases: a null page is an empty payload; a null url or id is left out of the header, and is null
when read.  Line ends in urls are percent-encoded.  Pages of one hot payload never meet in a task.
An empty table gives archives without records.  Broken chains end at the break: records behind a
damaged header are not trusted, nor is a record without its end mark.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioql.llm._common import attach_groups, batches_of, cut, shared_dir

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_FROM = 100
#: Revisit tables of up to so many rows (24 bytes each) are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000
DATE = "2024-01-01T00:00:00Z"


def plan_records(pages: DataFrame, id_column: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """id, url, body, digest and refers_to (null for responses) of every page."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("body"), F.sha2(body.cast("binary"), 256).alias("digest"))
    narrow = rows.where(F.octet_length("body") >= REVISIT_FROM).select("page_id", "digest")
    groups = narrow.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    groups = cut(groups)
    n, total = groups.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n <= BROADCAST_ROWS:
        found = rows.join(F.broadcast(groups), "digest", "left")
    else:
        found = attach_groups(rows, groups, "digest", "n", total)
    other = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return found.select("page_id", "url", "body", "digest", F.when(F.col("first_id").isNotNull() & other, F.col("first_id")).alias("refers_to"))


def record_text(plan: DataFrame) -> DataFrame:
    """The records as text, without the separator behind them."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))
    urn = lambda value: F.concat(F.lit("<urn:page:"), value.cast("string"), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("body").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("body")))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("|", F.col("page_id").cast("string"), F.col("digest")).cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">\r\n"),
        line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), line("X-Page-ID", F.col("page_id")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\n"), line("WARC-Refers-To", urn(F.col("refers_to"))), line("X-Refers-To-Page", F.col("refers_to")))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block,
    )
    return plan.select(head.alias("value"))


def write_warc(pages: DataFrame, path: str, **names: str) -> None:
    record_text(plan_records(pages, **names)).write.mode("overwrite").option("lineSep", END).text(path)


# --- reading ----------------------------------------------------------------------------------

_FIELDS = "page_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, http_status int, content_type string"


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for part in raw.split(b"\r\n"):
        name, colon, value = part.partition(b":")
        if colon:
            out[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def parse_unit(unit: bytes) -> tuple[int, dict[str, str], int] | None:
    """What follows a magic line: header length (with its blank line), headers and content length."""
    at = unit.find(b"\r\n\r\n")
    if at < 0:
        return None
    found = _headers(unit[:at])
    length = found.get("content-length", "")
    if "warc-type" not in found or not (length.isascii() and length.isdigit()):
        return None
    return at + 4, found, int(length)


def describe(headers: dict[str, str], block: bytes) -> tuple[dict, bytes]:
    """The row of a whole record, and its payload."""
    payload, http, status = block, {}, None
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _headers(head)
        words = head.split(b"\r\n", 1)[0].split()
        status = int(words[1]) if len(words) > 1 and words[1].isdigit() else None
    revisit = headers["warc-type"] == "revisit"
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest()
    size = int(http.get("content-length", 0)) if revisit else len(payload)
    row = {"page_id": headers.get("x-page-id"), "record_type": headers["warc-type"], "url": headers.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest, "refers_to": headers.get("x-refers-to-page"), "http_status": status, "content_type": headers.get("content-type")}
    return row, payload


def _units(spark: SparkSession, path: str) -> DataFrame:
    """Runs between magic lines, with the file and the start of the split they were read in."""
    lines = spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


_ROW_TYPES = {"page_id": pa.string(), "record_type": pa.string(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.string(), "http_status": pa.int32(), "content_type": pa.string()}
_CANDIDATE = {"path": pa.string(), "block": pa.int64(), "at": pa.int64(), "size": pa.int64(), "span": pa.int64(), "exit": pa.int64(), "whole": pa.bool_()} | _ROW_TYPES | {"payload": pa.binary()}


def _candidates(with_payload: bool):
    """For each run: where it lies in its split, and if it can be a record, how far that reaches.

    `at` and `exit` are relative to the first run of the split; `exit` is the first offset behind the
    split on the chain from this candidate, or -1 where the chain breaks inside the split.
    """
    m = len(MAGIC)

    def finish(rows: list[dict], size: int):
        known = {r["at"]: r for r in rows}
        for r in reversed(rows):
            to = r["at"] + r["span"]
            r["exit"] = -1 if r["span"] < 0 else to if to >= size - m else known[to]["exit"] if to in known else -1
        # a batch of rows at a time: payloads may be long
        for k in range(0, len(rows), 500):
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows[k : k + 500]], t) for n, t in _CANDIDATE.items()], names=list(_CANDIDATE))

    def run(batches):
        split, rows, size = None, [], 0
        for batch in batches:
            for path, block, value in zip(*batches_of(batch, "path", "block", "value")):
                if (path, block) != split:
                    yield from finish(rows, size)
                    split, rows, size = (path, block), [], 0
                row = {"path": path, "block": block, "at": size - m, "size": len(value), "span": -1, "whole": False}
                if found := parse_unit(value):
                    head, headers, length = found
                    row["span"] = m + head + length + len(END)
                    row["whole"] = head + length + len(END) == len(value) and value.endswith(b"\r\n\r\n")
                    if row["whole"]:
                        fields, payload = describe(headers, value[head : head + length])
                        row |= fields | ({"payload": payload} if with_payload else {})
                rows.append(row)
                size += len(value) + m
        yield from finish(rows, size)

    return run


def chain_starts(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits with their first offset in the file (`base`), and the entry offset of each split on the chain from 0."""
    sizes = candidates.groupBy("path", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    w = W.partitionBy("path").orderBy("block")
    splits = cut(sizes.withColumn("base", F.coalesce(F.sum("bytes").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("nth", F.row_number().over(w)))
    most = splits.agg(F.max("nth")).first()[0] or 0
    reach = splits.where("nth = 1").select("path", F.lit(0).cast("long").alias("offset"))
    if most > 1:
        jump = cut(candidates.where("exit >= 0").join(splits.select("path", "block", "base"), ["path", "block"]).select("path", (F.col("base") + F.col("at")).alias("offset"), (F.col("base") + F.col("exit")).alias("to")))
        width = 1
        while width < most:  # reach doubles: after k rounds it holds 2^k splits of the chain
            step = reach.join(jump, ["path", "offset"]).select("path", F.col("to").alias("offset"))
            reach = cut(reach.union(step).distinct())
            width *= 2
            if width < most:
                further = jump.select("path", F.col("offset").alias("to"), F.col("to").alias("then"))
                jump = cut(jump.join(further, ["path", "to"]).select("path", "offset", F.col("then").alias("to")))
    return splits, reach


def _walk(table: pa.Table) -> pa.Table:
    """The candidates of one split that lie on the chain from its entry."""
    import pyarrow.compute as pc

    at, span, entry = table["at"].to_pylist(), table["span"].to_pylist(), table["entry"].to_pylist()
    place = {a: k for k, a in enumerate(at)}
    keep = [False] * len(at)
    k = place.get(entry[0]) if entry and entry[0] is not None else None
    while k is not None and span[k] >= 0:
        keep[k] = True
        k = place.get(at[k] + span[k])
    return table.append_column("kept", pa.array(keep)).drop_columns("entry") if len(at) else table.append_column("kept", pc.cast(pa.array([], pa.null()), pa.bool_())).drop_columns("entry")


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record on the chain: path, offset, header fields, payload size and digest (and payload)."""
    m = len(MAGIC)
    candidates = cut(_units(spark, path).mapInArrow(_candidates(with_payload), "path string, block long, at long, size long, span long, exit long, whole boolean, " + _FIELDS + ", payload binary"))
    splits, reach = chain_starts(candidates)
    # a chain enters a split at one place at most: the runs of a split lie side by side
    based = candidates.join(splits.select("path", "block", "base"), ["path", "block"])
    bounds = splits.select("path", "block", "base", "bytes")
    entries = reach.join(bounds, "path").where((F.col("offset") >= F.col("base") - m) & (F.col("offset") < F.col("base") - m + F.col("bytes"))).groupBy("path", "block").agg((F.min(F.col("offset") - F.col("base"))).alias("entry"))
    ready = based.join(entries, ["path", "block"], "left")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema if f.name != "entry")
    walked = ready.groupBy("path", "block").applyInArrow(_walk, fields + ", kept boolean")
    offset = (F.col("base") + F.col("at")).alias("offset")
    names = list(_ROW_TYPES) + ["payload"] * with_payload
    walked = cut(walked)
    whole = walked.where("kept AND whole").select("path", offset, *names)
    open_ = walked.where("kept AND NOT whole").select("path", offset, (F.col("base") + F.col("at") + F.col("span")).alias("end"))
    if open_.isEmpty():
        return whole
    return whole.union(_assembled(spark, path, walked, names))


def _assembled(spark: SparkSession, path: str, walked: DataFrame, names: list[str]) -> DataFrame:
    """Records whose payload holds magic: their runs are read again and joined in order."""
    magic = MAGIC.encode()
    w = W.partitionBy("path").orderBy(F.col("base") + F.col("at"))
    start = F.when(F.col("kept"), F.struct((F.col("base") + F.col("at")).alias("offset"), F.col("whole").alias("closed"), (F.col("base") + F.col("at") + F.col("span")).alias("end")))
    owned = walked.withColumn("own", F.last(start, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    owned = owned.where("own IS NOT NULL AND NOT own.closed AND base + at < own.end").select("path", "block", "at", F.col("own.offset").alias("offset"))

    def places(batches):
        split, size = None, 0
        for batch in batches:
            paths, blocks, values = batches_of(batch, "path", "block", "value")
            at = []
            for p, b, v in zip(paths, blocks, values):
                if (p, b) != split:
                    split, size = (p, b), 0
                at.append(size - len(magic))
                size += len(v) + len(magic)
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "block": pa.array(blocks, pa.int64()), "at": pa.array(at, pa.int64()), "value": pa.array(values, pa.binary())})

    again = _units(spark, path).mapInArrow(places, "path string, block long, at long, value binary")

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("at", "ascending")])
        unit = magic.join(table["value"].to_pylist())
        head, headers, length = parse_unit(unit)
        kinds = {"path": pa.string(), "offset": pa.int64()} | _ROW_TYPES | {"payload": pa.binary()}
        if unit[head + length : head + length + len(END)] != END.encode():  # cut off, or the length is wrong
            return pa.table({n: pa.array([], kinds[n]) for n in ["path", "offset", *names]})
        row, payload = describe(headers, unit[head : head + length])
        row |= {"path": table["path"][0].as_py(), "offset": table["offset"][0].as_py(), "payload": payload}
        return pa.table({n: pa.array([row[n]], kinds[n]) for n in ["path", "offset", *names]})

    fields = "path string, offset long, " + _FIELDS + (", payload binary" if "payload" in names else "")
    return again.join(owned, ["path", "block", "at"]).groupBy("path", "offset").applyInArrow(join, fields)


def round_trip(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """Write archives to the shared folder, read them back, and describe every page."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4()}"
    write_warc(pages, path, id_column=id_column)
    kind = pages.schema[id_column].dataType
    return read_warc(spark, path).select(F.col("page_id").cast(kind).alias(id_column), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
