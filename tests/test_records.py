"""Escape rules, record assembly, encodings and the block reader, against a
character-by-character loader written for the tests."""

import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from campfin.functions.text import record_fields
from campfin.operators.parse import parse_kind, render
from campfin.operators.repairs import repair_counts
from campfin.plans import runs
from campfin.schemas import CM_FIELDS
from campfin.sources import ziplines
from campfin.sources.ziplines import ZipLinesReader, list_entries, read_archives, read_zip_lines, records

CONTROL = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}


def load_char_by_char(text):
    """Fields of one record, read the way a bulk loader walks over it."""
    fields, now, null, i = [], [], False, 0
    while i < len(text):
        c = text[i]
        if c == "\\" and i + 1 < len(text):
            i += 1
            null |= text[i] == "N"
            now.append(CONTROL.get(text[i], text[i]))
        elif c == "|":
            fields.append(None if null and now == ["N"] else "".join(now))
            now, null = [], False
        else:
            now.append(c)
        i += 1
    fields.append(None if null and now == ["N"] else "".join(now))
    return fields


def test_fields_equal_the_walk(spark):
    rnd = random.Random(11)
    texts = ["", "|", "\\", "\\\\", "\\N", "\\N|\\\\N|x\\N|\\Nx", "a\\|b|c", "a\\\\|b", "end\\", "\\|\\", "N", "é\\é|\\😀"]
    texts += ["".join(rnd.choice(["a", "|", "\\", "N", "n", "t", "é", "0", "\\N", "|\\N|"]) for _ in range(rnd.randint(0, 12)))
              for _ in range(3000)]
    texts.append("x" * 300_000 + "\\|" * 20_000)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    for r in df.select("v", record_fields("v").alias("f")).collect():
        assert r["f"] == load_char_by_char(r["v"]), r["v"][:80]


def test_null_value_and_literal_mark(spark):
    df = spark.createDataFrame([("12", "C1|\\N|\\\\N", 1), ("12", None, 2)], "y2 string, value string, _order long")
    r = parse_kind(df, "cm").orderBy("_order").collect()
    assert r[0]["name"] is None and r[0]["treasurer"] == "\\N"   # an escaped mark is text
    assert r[1]["cm_id"] == "" and r[1]["name"] is None


def test_dimension_record_over_lines_meets_its_cycle(spark):
    value = "C1|NAME\\\nC2|X"
    df = spark.createDataFrame([("12", value, 1)], "y2 string, value string, _order long")
    r = parse_kind(df, "cm").first()
    assert (r["cm_id"], r["name"], r["treasurer"], r["street_1"]) == ("C1", "NAME\n12", "C2", "X")
    fact = spark.createDataFrame([("12", "C1|N\\\n1|Q1", 1)], "y2 string, value string, _order long")
    r = parse_kind(fact, "indiv").first()
    assert (r["cmte_id"], r["amndt_ind"], r["rpt_tp"]) == ("C1", "N", "Q1")   # cut to one character


def test_render_round_trip_with_escapes(spark):
    names = [f[0] for f in CM_FIELDS]
    row = ("C1", "A|B\\C", "line\nend", "\\N", None, "t\r", "TX", "1", "P", "H", "D", "Q", "", "x\\", "S")
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
    line = df.select(F.lit("12").alias("y2"), render(df, CM_FIELDS).alias("value"), F.lit(1).alias("_order"))
    assert tuple(parse_kind(line, "cm").select(*names).first()) == row
    assert "\n" not in line.first()["value"]


def whole(data, encoding="utf-8"):
    return list(io.TextIOWrapper(io.BytesIO(data), encoding=encoding, errors="replace", newline=None))


def cut(data, encoding="utf-8", escape="", block=7):
    out = []
    for numbers, lines, bad in records(io.BytesIO(data), encoding, escape, block):
        out += list(zip(numbers.tolist(), lines.to_pylist(), [0] * len(lines) if bad is None else bad.tolist()))
    return out


def test_blocks_equal_whole_text_reading():
    rnd = random.Random(3)
    for _ in range(400):
        data = b"".join(rnd.choice([b"a", b"bc", b"\n", b"\r", b"\r\n", "é".encode(), "😀".encode(), b"|", b"\xff", b""])
                        for _ in range(rnd.randint(0, 40)))
        want = [x[:-1] if x.endswith("\n") else x for x in whole(data)]
        for block in (1, 2, 5, 1000):
            got = cut(data, block=block)
            assert [v for _, v, _ in got] == want, data
            assert [n for n, _, _ in got] == list(range(1, len(want) + 1))
            assert sum(b for _, _, b in got) == data.count(b"\xff")


def test_records_span_escaped_line_ends():
    rnd = random.Random(4)
    for _ in range(400):
        lines = ["".join(rnd.choice(["a", "\\", "|", "\\\\"]) for _ in range(rnd.randint(0, 4)))
                 for _ in range(rnd.randint(1, 8))]
        data = "\n".join(lines).encode()
        want, open_ = [], False
        for i, x in enumerate(whole(data)):
            x = x.rstrip("\n")
            if open_:
                want[-1][1] += "\n" + x
            else:
                want.append([i + 1, x])
            open_ = (len(x) - len(x.rstrip("\\"))) % 2 == 1
        for block in (1, 3, 1000):
            assert [[n, v] for n, v, _ in cut(data, escape="\\", block=block)] == want, data


def test_encodings():
    text = "Café|naïve\nzwei\r\ndrei"
    for enc in ("utf-8", "iso-8859-1", "cp1252", "utf-16", "utf-16-le"):
        got = cut(text.encode(enc), enc, block=6)
        assert [v for _, v, _ in got] == ["Café|naïve", "zwei", "drei"] and not any(b for *_, b in got)
    wrong = cut("é ok\nfine\nàé".encode("iso-8859-1"), "utf-8")
    assert [(v, b) for _, v, b in wrong] == [("� ok", 1), ("fine", 0), ("��", 2)]
    undefined = cut(b"a\x81b\nc", "cp1252")   # a byte that the encoding leaves undefined
    assert [(v, b) for _, v, b in undefined] == [("a�b", 1), ("c", 0)]


def _zip(path, entries):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, data in entries.items():
            zf.writestr(name, data)
    return str(path)


def test_archives_of_two_encodings_in_one_run(spark, tmp_path):
    cm = "C{i}|Café {i}|T|||CITY|TX|75001|P|H|DEM|Q||ORG|S1\n"
    _zip(f"{tmp_path}/2004/cm04.zip", {"cm.txt": cm.format(i="00000004").encode("iso-8859-1")})
    _zip(f"{tmp_path}/2012/cm12.zip", {"cm.txt": cm.format(i="00000012").encode("utf-8"), "dir/": b""})
    _zip(f"{tmp_path}/2010/cm10.zip", {"cm.txt": cm.format(i="00000010").encode("iso-8859-1")})
    bronze = runs.land(spark, f"file:{tmp_path}", "full", [("/2004/", "iso-8859-1")])
    names = {r["y2"]: r["name"] for r in parse_kind(bronze.withColumn("_order", F.lit(1)), "cm").collect()}
    assert names == {"04": "Café 00000004", "12": "Café 00000012", "10": "Caf� 00000010"}
    counts = {(r["kind"], r["repair"]): r["count"] for r in repair_counts(bronze).collect()}
    assert counts["cm", "replaced_bytes"] == 1 and counts["cm", "escaped_lines"] == 0


def test_repairs_count_escapes_and_joined_lines(spark):
    rows = [("cm", "12", "C1|A\\|B", 0), ("cm", "12", "C1|\\N|\\N", 0), ("cm", "12", "C2|x\\\ny", 3),
            ("cm", "12", "C2|x\\N", 0), ("cm", "12", None, None)]
    df = spark.createDataFrame(rows, "kind string, y2 string, value string, replaced int")
    got = {r["repair"]: r["count"] for r in repair_counts(df).collect()}
    assert (got["escaped_lines"], got["joined_lines"], got["replaced_bytes"], got["null_fields"]) == (3, 1, 3, 2)


def test_the_driver_opens_no_archive(spark, tmp_path, monkeypatch):
    a = _zip(f"{tmp_path}/a/oth12.zip", {f"e{i}.txt": b"l\n" * (i + 1) for i in range(3)})
    b = _zip(f"{tmp_path}/b/oth10.zip", {"x.txt": b"1\n2\n"})

    def never(*_):
        raise AssertionError("opened on the driver")

    monkeypatch.setattr(ziplines, "_open_input", never)
    listed = list_entries(spark, [(a, 0, "oth", "12", "utf-8"), (b, 1, "oth", "10", "utf-8")]).collect()
    assert sorted((r["entry"], r["size"]) for r in listed) == [("e0.txt", 2), ("e1.txt", 4), ("e2.txt", 6), ("x.txt", 4)]
    assert read_zip_lines(spark, str(tmp_path)).count() == 8
    parts = ZipLinesReader({"path": str(tmp_path)}).partitions()
    assert sorted(p.path for p in parts) == sorted([a, b])
    tagged = read_archives(spark, [(a, 7, "oth", "12", "utf-8")])
    assert {(r["file_no"], r["kind"], r["y2"]) for r in tagged.collect()} == {(7, "oth", "12")}
    assert tagged.rdd.getNumPartitions() == 3   # one task an entry


def test_plain_load_and_no_archives(spark, tmp_path):
    _zip(f"{tmp_path}/2012/oth12.zip", {"a.txt": b"1\\\n2\n", "b.txt": b""})
    ziplines.register(spark)
    df = spark.read.format("ziplines").load(str(tmp_path))
    assert sorted((r["line_no"], r["value"]) for r in df.collect()) == [(1, "1\\"), (2, "2")]
    joined = spark.read.format("ziplines").option("escape", "\\").load(str(tmp_path))
    assert [(r["line_no"], r["value"]) for r in joined.collect()] == [(1, "1\\\n2")]
    assert read_archives(spark, []).count() == 0
    empty = tmp_path / "none"
    empty.mkdir()
    assert read_zip_lines(spark, str(empty)).count() == 0


def test_a_broken_archive_fails_the_read(spark, tmp_path):
    os.makedirs(f"{tmp_path}/2012")
    with open(f"{tmp_path}/2012/oth12.zip", "wb") as fh:
        fh.write(b"no zip")
    with pytest.raises(Exception, match="not a zip"):
        read_zip_lines(spark, str(tmp_path)).count()


def test_archives_appear_whole_on_remote_folders_too(tmp_path, monkeypatch):
    """A task that dies while it writes leaves no archive under its final name."""
    import pandas as pd
    from pyarrow import fs as pafs

    class Remote:
        @staticmethod
        def from_uri(uri):
            return pafs.LocalFileSystem(), uri.replace("far://", f"{tmp_path}/")

    monkeypatch.setattr(pafs, "FileSystem", Remote)
    rows = pd.DataFrame({"_kind": ["oth"] * 3, "y2": ["12", "12", "10"], "_part": [0, 0, 1], "value": ["a", "b", "c"]})
    done = pd.concat(ziplines._archive_writer("far://feed", "utf-8")(iter([rows])))
    assert sorted(map(tuple, done.values)) == [("far://feed/2010/part-00001/oth10.zip", 1),
                                               ("far://feed/2012/part-00000/oth12.zip", 2)]
    with zipfile.ZipFile(tmp_path / "feed/2012/part-00000/oth12.zip") as zf:
        assert zf.read(zf.namelist()[0]) == b"a\nb\n"

    def dying():
        yield rows.head(1)
        raise OSError("lost")

    with pytest.raises(OSError):
        list(ziplines._archive_writer("far://other", "utf-8")(dying()))
    assert not [f for _, _, names in os.walk(tmp_path / "other") for f in names if f.endswith(".zip")]
