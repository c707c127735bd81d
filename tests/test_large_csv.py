"""The block-wise CSV reader against Python's csv module, on text with quotes, line ends and carriage returns anywhere."""

import csv
import io
import itertools
import random

import pytest

from ledgerline.sources import large_csv, registers


def _plain(text):
    """Numbered records, blank lines not counted."""
    return [(n, r) for n, r in enumerate((r for r in csv.reader(io.StringIO(text, newline="")) if r), 1)]


def _texts():
    rng = random.Random(6)
    yield from ["", "\n\n", "a,b\n1,2", 'a\n"x\ny",2\n', '"a\n', 'a"b,c"\nd', '"a"b"c,\n"d""\n",e\n', "a\rb\r\nc\r\r\n\nd", '""\n"""\n"\n', ',\n,"\r\n",\n', '"x"\r"y\rz"\r\n']
    for _ in range(400):
        yield "".join(rng.choices(['"', '""', ",", "\n", "\r", "\r\n", "a", "é", " "], weights=[5, 1, 4, 4, 1, 1, 6, 1, 1], k=rng.randrange(1, 40)))


def test_blocks_cut_at_every_line_end():
    """Any cut between physical lines: maps compose, and parsing the blocks gives the records of the whole."""
    for text in _texts():
        lines = text.split("\n")[: -1 if text.endswith("\n") else None]
        whole = large_csv.block_map(lines)
        if whole[0][0]:  # a quote that is never closed: the file's last line end isn't in its cell
            text = text.removesuffix("\n")
        for cut in range(len(lines) + 1):
            blocks = [lines[:cut], lines[cut:]]
            maps = [large_csv.block_map(b) for b in blocks]
            assert large_csv.compose(*maps) == whole
            found, pieces, quoted, number = [], {}, False, 0
            for block, map_ in zip(blocks, maps, strict=True):
                for n, cells, piece in large_csv.parse(block, quoted, number):
                    if piece is None:
                        found.append((n, cells))
                    else:
                        pieces.setdefault(n, []).append(piece)
                quoted, number = map_[quoted][0], number + map_[quoted][1]
            found += [(n, next(csv.reader(io.StringIO("\n".join(p), newline="")))) for n, p in pieces.items()]
            assert sorted(found) == _plain(text), repr(text)


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_files_in_blocks_of_bytes(spark, tmp_path, size):
    """Spark cuts the files at every few bytes; rows, numbers and refusals are those of the reader of whole files."""
    rng = random.Random(size)
    cell = lambda: "".join(rng.choices(["x", '""', ",", "\n", "\r\n", "é", "a\n"], k=rng.randrange(5)))
    texts = {
        "plain": "id,Name \n" + "\n".join(f"{i},n{i}" for i in range(6)),
        "quoted": "﻿id,Name \r\n" + "".join(f'{i},"{cell()}"\r\n' for i in range(6)),
        "header": '"id","Na\nme "\n1,2\n',
        "twice": "id,id,Name \n1,2,3\n4\n5,6,7,8\n",
        "headonly": "id,Name \n\n", "blank": "\n\n", "lacks": "id\n1\n", "open": 'id,Name \n1,"never\nclosed',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1" if size < 1000 else "4194304"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = large_csv.cells(spark, str(tmp_path), ["id", "Name "]).collect()
    finally:
        for k in settings:
            spark.conf.unset(k)
    whole = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    want = registers.cells(whole, ["id", "Name "]).collect()
    name = lambda p: p.rsplit("/", 1)[1]
    plain = lambda rows: sorted((name(r.path), r.line or 0, str(sorted((r.cells or {}).items())), r.fatal or "") for r in rows)
    assert plain(got) == plain(want)
    assert {name(r.path): r.fatal for r in got if r.fatal} == {"headonly.csv": "no data rows", "blank.csv": "no header", "lacks.csv": "missing columns: Name ", "header.csv": "missing columns: Name "}


def test_states_of_blocks(spark):
    """The window gives what running the maps one after another gives."""
    rng = random.Random(1)
    rows = [(f"f{f}", b, *itertools.chain(*[(rng.random() < 0.5, rng.randrange(5)) for _ in range(2)]), False) for f in range(4) for b in range(50)]
    got = {(r.path, r.block): (r.quoted, r.number) for r in large_csv.placed(spark.createDataFrame(rows, large_csv.MAPS)).collect()}
    for f in range(4):
        quoted, number = False, 0
        for path, block, a, n, b, m, _ in (r for r in rows if r[0] == f"f{f}"):
            assert got[path, block] == (quoted, number)
            quoted, number = (b, number + m) if quoted else (a, number + n)


def test_bytes_that_are_no_text(spark, tmp_path):
    (tmp_path / "bad.csv").write_bytes(b"id\n1\n\xff\xfe\n")
    rows = large_csv.cells(spark, str(tmp_path / "bad.csv"), ["id"]).collect()
    assert [r.fatal for r in rows] == ["not UTF-8"]
