import hashlib
import zipfile
import zlib
from pathlib import Path

import pytest

from inkstrata.llm import media as M

TEXTS = [None, "", "x", "y" * 192, "z" * 193, "été \U0001f600" * 1000, "long " * 60000]


def test_png_round_trip():
    for t in TEXTS:
        p = M.padded((t or "").encode())
        assert p and len(p) % M.ROW == 0
        assert M.decode_png(M.encode_png(p)).tobytes() == p
    with pytest.raises(ValueError):
        M.decode_png(M.encode_png(b"a" * 192)[:-20] + b"0" * 20)


def test_every_row_is_read_back(spark, monkeypatch):
    rows = [(i, t, "m") for i, t in enumerate(TEXTS)] + [(1, "", "m"), (None, "no id", "m")]
    folder, listed = M.write_media(spark.createDataFrame(rows, "doc_id long, text string, media string").repartition(2))
    assert sum(r.members for r in listed.collect()) == len(rows)
    source = M.read_media(spark, folder)
    got = M.media_features(source).collect()
    want = sorted((str(i) if i is not None else "", hashlib.sha256(M.padded((t or "").encode())).hexdigest(), len((t or "").encode())) for i, t, _ in rows)
    assert sorted((r.id or "", r.payload_sha256, r.n_bytes) for r in got) == want
    assert len({r.media_sha256 for r in got if r.n_bytes == 0}) == 1
    assert all(r.tail_crc32 == zlib.crc32(b" " * 16) for r in got if r.n_bytes == 0)
    small = spark.read.format("inkstrata_media").option("splitBytes", 500).load(folder)
    assert small.rdd.getNumPartitions() > source.rdd.getNumPartitions() and small.count() == len(rows)


def test_a_member_is_retried_by_itself(spark):
    folder, _ = M.write_media(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1))
    path = next(Path(folder.removeprefix("file:")).glob("*.zip"))
    reader = M.MediaReader({"path": folder})
    fs, _ = M._filesystem(folder)
    opened = []

    class Flaky:
        def open_input_file(self, p):
            opened.append(p)
            if len(opened) == 1:
                raise OSError("lost")
            return fs.open_input_file(p)

    with zipfile.ZipFile(path) as z:
        first = z.infolist()[0]
    assert M.decode_png(reader.member(Flaky(), str(path), first)).tobytes()[:1] == b"a" and len(opened) == 2
    data = bytearray(path.read_bytes())
    data[first.header_offset + 60] ^= 255
    path.write_bytes(data)
    with pytest.raises(OSError):
        reader.member(fs, str(path), first)


def test_empty_table(spark):
    folder, listed = M.write_media(spark.createDataFrame([], "doc_id long, text string"))
    assert listed.count() == 0 and M.media_features(M.read_media(spark, folder)).count() == 0
