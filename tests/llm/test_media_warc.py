import hashlib
import os
import random
import zlib

import numpy as np
import pytest

from folioql.llm import matroska, warc


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 2047, 2048, 2049, 4097, 16384, 16385, 65536, 65537, 300_001])
def test_media_round_trip(n):
    size, payload = matroska.padded("a" * n)
    media = matroska.demux(stored := matroska.mux(payload))
    assert size == n and len(payload) % 64 == 0 and payload
    assert matroska.samples(stored, media) == payload and media.doc_type == "matroska" and media.tracks[1]["bits"] == 8
    assert [c for _, _, c in media.cues] == media.clusters
    times = [p.time_ns for p in media.packets]
    assert times == sorted(times) and len(set(times)) == len(times)


@pytest.mark.parametrize("kind", [matroska.XIPH, matroska.FIXED, matroska.EBML_LACE])
def test_lacing(kind):
    frames = [os.urandom(40 if kind == matroska.FIXED else k) for k in (40, 300, 1, 0, 900, 255, 510, 77)]
    body = matroska.lace(frames, kind)
    at, *sizes = matroska.unlace(body, 0, len(body), kind)
    assert sizes == [len(f) for f in frames] and body[at:] == b"".join(frames)


def test_unknown_sizes_groups_and_damage():
    block = matroska.element(matroska.BLOCK, b"\x81\x00\x05\x00" + b"abcd")
    cluster = matroska.CLUSTER.to_bytes(4, "big") + b"\xff" + matroska.unsigned(matroska.TIME, 10) + matroska.element(matroska.GROUP, block)
    data = matroska.element(matroska.EBML, b"") + matroska.SEGMENT.to_bytes(4, "big") + b"\xff" + cluster + matroska.element(matroska.CUES, b"")
    media = matroska.demux(data)
    assert [(p.time_ns, data[p.offset : p.offset + p.length]) for p in media.packets] == [(15_000_000, b"abcd")]
    with pytest.raises(ValueError):
        matroska.demux(matroska.mux(b"\0" * 64)[:-20])
    with pytest.raises(ValueError):
        matroska.read_vint(b"\x00", 0)


# A reader of its own, from the published format: sizes are of 1 to 8 bytes, length given by leading zero bits.


def number(data, at, marked):
    size = 9 - data[at].bit_length()
    value = int.from_bytes(data[at : at + size], "big")
    return value if marked else value & (1 << 7 * size) - 1, at + size


def elements(data, at, end):
    while at < end:
        kind, at = number(data, at, True)
        size, at = number(data, at, False)
        yield kind, at, at + size
        at += size


def read_media(data):
    """(time, frames) of every block, cue points, cluster places and the sampling rate, in milliseconds of the default scale."""
    blocks, cues, clusters, rate = [], [], [], None
    (_, head, head_end), (kind, segment, end) = elements(data, 0, len(data))
    assert kind == 0x18538067 and data[:4].hex() == "1a45dfa3"
    for kind, a, b in elements(data, segment, end):
        if kind == 0x1F43B675:  # Cluster
            clusters.append(a)
            for k, x, y in elements(data, a, b):
                if k == 0xE7:
                    base = int.from_bytes(data[x:y], "big")
                elif k in (0xA3, 0xA0):  # SimpleBlock, or a BlockGroup's Block
                    for block, p, q in [(k, x, y)] if k == 0xA3 else [e for e in elements(data, x, y) if e[0] == 0xA1]:
                        _, p = number(data, p, False)
                        time, flags, p = base + int.from_bytes(data[p : p + 2], "big", signed=True), data[p + 2], p + 3
                        lacing, sizes = flags >> 1 & 3, []
                        if lacing:
                            n, p = data[p] + 1, p + 1
                            if lacing == 1:
                                for _ in range(n - 1):
                                    size = 0
                                    while data[p] == 255:
                                        size, p = size + 255, p + 1
                                    sizes.append(size + data[p])
                                    p += 1
                            elif lacing == 3:
                                size, p = number(data, p, False)
                                sizes.append(size)
                                for _ in range(n - 2):
                                    width = 9 - data[p].bit_length()
                                    step, p = number(data, p, False)
                                    sizes.append(sizes[-1] + step - ((1 << 7 * width - 1) - 1))
                            else:
                                sizes = [(q - p) // n] * (n - 1)
                        frames = []
                        for size in [*sizes, q - p - sum(sizes)]:
                            frames.append(data[p : p + size])
                            p += size
                        blocks.append((time, frames))
        elif kind == 0x1C53BB6B:  # Cues
            cues = [e for e in elements(data, a, b) if e[0] == 0xBB]
    return blocks, cues, clusters


def test_stored_form_by_another_reader(messy, rows, empty):
    got = {(r.doc_id, r.n_bytes): r for r in matroska.media_digests(messy).collect()}
    files = {(r.doc_id, len(r.text or "")): bytes(r.media) for r in matroska.encode_media(messy).withColumnRenamed("media", "_m").join(messy.select("doc_id", "text").distinct(), "doc_id").selectExpr("doc_id", "text", "_m AS media").collect()}
    assert len(files) > 20
    for i, t, *_ in rows:
        raw = (t or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 or 64 * (not raw))
        r = got[i, len(raw)]
        x = np.frombuffer(payload, np.uint8).astype(float) - 128
        said = dict(part.split("=") for part in r.feature.split(";"))
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert abs(float(said["mean"]) - x.mean()) < 1e-3 and abs(float(said["rms"]) - np.sqrt((x * x).mean())) < 1e-2 and abs(float(said["zcr"]) - np.count_nonzero(np.diff(x >= 0)) / len(x)) < 1e-4
        if i is not None and i not in (9, 200):  # ids of one row each
            stored = files[i, len(t or "")]
            blocks, cues, clusters = read_media(stored)
            assert b"".join(f for _, frames in blocks for f in frames) == payload
            assert [b[0] for b in blocks] == sorted(b[0] for b in blocks) and 0 < len(cues) == int(said["cues"]) <= len(clusters)
            assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest()) and int(said["packets"]) == sum(len(f) for _, f in blocks)


def test_media_columns(messy, rows, empty):
    got = {r.doc_id: r for r in matroska.media_digests(messy).collect() if r.doc_id is not None}
    for i, t, *_ in rows:
        if i is not None:
            n, payload = matroska.padded(t)
            assert (got[i].n_bytes, got[i].payload_sha256, got[i].media_sha256) == (n, hashlib.sha256(payload).hexdigest(), hashlib.sha256(matroska.mux(payload)).hexdigest())
    assert matroska.media_digests(empty).count() == 0
    files = matroska.encode_media(messy)
    packets = matroska.packet_table(files.where("doc_id = 7"))
    assert packets.count() > 10 and packets.agg({"length": "sum"}).first()[0] == got[7].payload_bytes


FAKE = warc.MAGIC + "WARC-Type: response\r\nX-Page-ID: 999\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.mark.parametrize("split", ["128m", "3k"])
def test_warc_rejects_magic_in_payloads(spark, split):
    r = random.Random(3)
    rows = []
    for i in range(150):
        h = "<p>" + "x" * r.randrange(0, 3000) + "é" * r.randrange(3)
        h += (FAKE + "tail") * (i % 7 == 0) + warc.MAGIC * 3 * (i % 11 == 0)
        h = "same " * 40 if i % 13 == 0 else None if i % 17 == 0 else "short" if i % 19 == 0 else h
        rows.append((i, f"http://x/{i}\r\n" if i % 5 else None, h, "clash"))
    rows += [rows[14], rows[26]]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = [tuple(x) for x in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    first, want = {}, []
    for i, _, h, _ in rows:
        body = (h or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        f = first.setdefault(digest, i) if len(body) >= 100 else i
        want.append((i, len(body), digest, "response" if f == i else "revisit", None if f == i else f))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_warc_edges(spark, tmp_path):
    schema = "page_id long, url string, html string"
    assert warc.round_trip(spark.createDataFrame([], schema)).count() == 0
    got = warc.round_trip(spark.createDataFrame([(None, None, None)], schema)).collect()
    assert [tuple(r) for r in got] == [(None, 0, hashlib.sha256(b"").hexdigest(), "response", None)]
    path = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame([(1, "u\n", "body")], schema), path)
    row = warc.read_warc(spark, path, with_payload=True).first()
    assert bytes(row.payload) == b"body" and row.url == "u%0A" and row.http_status == 200
    # behind a damaged record nothing is trusted
    (tmp_path / "d").mkdir()
    whole = (warc.MAGIC + "WARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n").encode()
    (tmp_path / "d" / "x.warc").write_bytes(whole + whole.replace(b"Length: 2", b"Length: 3") + whole)
    assert [r.offset for r in warc.read_warc(spark, str(tmp_path / "d")).collect()] == [0]
