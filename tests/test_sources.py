import csv
import hashlib
import io
import random

import pytest

from sievemark import discover_batches, inspect_batches, number_rows, read_batches
from sievemark.plans import lookup
from sievemark.sources import batches as batches_module, csv_batches, decoding, long_records as long_records_module
from sievemark.sources.batches import LINE_DIGEST, content_fingerprint, line_facts, locate_batch
from sievemark.sources.encodings import find_encoding

HEAD = "a,b,c\n"
YEARS = {"start_year": 2000, "end_year": 2030}


def write(folder, **files):
    for year, content in files.items():
        data = content if isinstance(content, bytes) else content.encode()
        (folder / f"food_inspections_{year[1:]}.csv").write_bytes(data)
    return str(folder)


def discover(spark, folder, pattern="food_inspections_*.csv", **years):
    return discover_batches(spark, folder, file_pattern=pattern, **(years or YEARS))


def test_discovery_order_and_filter(spark, tmp_path):
    write(tmp_path, y2020=HEAD, y2019="", y2021=HEAD)
    (tmp_path / "food_inspections_2018.csv").mkdir()
    (tmp_path / "Food_inspections_2017.csv").write_text(HEAD)
    (tmp_path / "notes.txt").write_text("x")
    found = discover(spark, str(tmp_path))
    assert [(batch.year, batch.size_bytes) for batch in found] == [(2019, 0), (2020, 6), (2021, 6)]
    assert discover(spark, str(tmp_path), "nothing*") == []


@pytest.mark.parametrize("pattern", ["", " ", "a/b*.csv", "a\\b.csv", "..", None])
def test_bad_file_patterns(spark, tmp_path, pattern):
    with pytest.raises(ValueError, match="file pattern"):
        discover(spark, str(tmp_path), pattern)


def test_discovery_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="not found"):
        discover(spark, str(tmp_path / "none"))
    write(tmp_path, y2019=HEAD)
    with pytest.raises(ValueError, match="outside"):
        discover(spark, str(tmp_path), start_year=2020, end_year=2021)
    (tmp_path / "food_inspections_20.csv").write_text(HEAD)
    with pytest.raises(ValueError, match="convention"):
        discover(spark, str(tmp_path))
    with pytest.raises(ValueError, match="not found"):
        locate_batch(spark, str(tmp_path / "food_inspections_2022.csv"), **YEARS)
    assert locate_batch(spark, str(tmp_path / "food_inspections_2019.csv"), **YEARS).year == 2019


def test_checksums_are_those_of_the_bytes(spark, tmp_path):
    content = b"a,b,c\r\n1,\xff,3\n"
    folder = write(tmp_path, y2019=content, y2020=b"")
    batches = discover(spark, folder)
    for name in ("sha256", " SHA512 ", "md5", "sha1", "sha384", "sha224", "blake2b", "sha3_256"):
        rows = inspect_batches(spark, batches, algorithm=name).orderBy("batch_year").collect()
        plain = name.strip().lower()
        digests = [hashlib.new(plain, data).hexdigest() for data in (content, b"")]
        assert [row.checksum for row in rows] == digests
        assert [row.checksum_algorithm for row in rows] == [plain, plain]
        assert [row.size_bytes for row in rows] == [len(content), 0]
    with pytest.raises(ValueError, match="unsupported hash"):
        inspect_batches(spark, batches, algorithm="crc")


def test_line_digest_sees_order_but_not_splits(spark, tmp_path):
    lines = [f"{i},{i * 7 % 13},x" for i in range(3000)]
    swapped = [*lines[:1000], lines[1001], lines[1000], *lines[1002:]]
    folder = write(
        tmp_path, y2019="\n".join(lines), y2020="\n".join(swapped), y2021="\n".join(lines) + "\n"
    )
    batches = discover(spark, folder)
    seen = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split in (before, "3000", "7001"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        rows = inspect_batches(spark, batches).orderBy("batch_year").collect()
        seen.append([row.checksum for row in rows])
        assert {row.checksum_algorithm for row in rows} == {LINE_DIGEST}
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1] == seen[2]
    assert seen[0][0] != seen[0][1]
    assert seen[0][0] == seen[0][2]  # the size tells these two apart


def test_line_digest_sees_every_byte_of_a_line_break(spark, tmp_path):
    folder = write(tmp_path, y2019=b'a\n1,"x\ry"\n', y2020=b'a\n1,"x\ny"\n', y2021=b'a\r1,"x\ry"\n')
    rows = inspect_batches(spark, discover(spark, folder)).collect()
    assert len({row.checksum for row in rows}) == 3 and len({row.size_bytes for row in rows}) == 1


def test_whole_digests_of_files_larger_than_a_split(spark, tmp_path):
    """A digest of all bytes is taken as a stream, in one task a file, and never of a whole file at once."""
    rng = random.Random(5)
    contents = {
        2019: b"".join(bytes(rng.randrange(256) for _ in range(rng.randrange(60))) + b"\n" for _ in range(4000)),
        2020: b"\n" * 3000,
        2021: b"\r\n".join(b"x" * i for i in range(300)),
        2022: b"no line feed" * 5000,
        2023: b"\xff\xfe\x00\n\n",
    }
    folder = write(tmp_path, **{f"y{year}": content for year, content in contents.items()})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        for name in ("sha256", "blake2b", "sha3_512", "md5"):
            found = inspect_batches(spark, discover(spark, folder), algorithm=name).collect()
            assert {r.batch_year: r.checksum for r in found} == {
                year: hashlib.new(name, content).hexdigest() for year, content in contents.items()
            }
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "700"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name in ("shake_128", "", None, "crc32"):
        with pytest.raises(ValueError, match="unsupported hash"):
            inspect_batches(spark, discover(spark, folder), algorithm=name)


def tree_by_hand(content, fan):
    lines = content.removesuffix(b"\n").split(b"\n")
    level = [hashlib.sha256(b"0:" + line).hexdigest() for line in lines]
    while True:
        joined = ["".join(level[at : at + fan]) for at in range(0, len(level), fan)]
        level = [hashlib.sha256(b"1:" + text.encode()).hexdigest() for text in joined]
        if len(level) == 1:
            return f"{len(lines)}-{level[0]}"


@pytest.mark.parametrize("fan", [2, 7, 1024])
def test_line_digest_is_the_root_of_a_hash_tree(spark, tmp_path, monkeypatch, fan):
    monkeypatch.setattr(batches_module, "FAN", fan)
    rng = random.Random(fan)
    text = b"".join(bytes(rng.randrange(14, 256) for _ in range(rng.randrange(30))) + b"\n" for _ in range(1500))
    at = len(text) // 2
    contents = {
        2001: text,
        2002: text[:at] + bytes([text[at] ^ 1 or 14]) + text[at + 1 :],  # one byte is another
        2003: b"one line",
        2004: b"\n",
        2005: text[: at // 2],
    }
    folder = write(tmp_path, **{f"y{year}": content for year, content in contents.items()})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("999", "4096", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            found = {r.batch_year: r.checksum for r in inspect_batches(spark, discover(spark, folder)).collect()}
            assert found == {year: tree_by_hand(content, fan) for year, content in contents.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(set(found.values())) == 5


def test_line_facts(spark, tmp_path):
    folder = write(
        tmp_path,
        y2001=HEAD + '1,"x, ""y""",\n',
        y2002=HEAD + '1,"x\ny",\n',
        y2003=HEAD + '1,5" and 6" pipes,3\n',
        y2004=HEAD.encode() + b"\xff,1,2\n",
        y2005=HEAD + '"a""b",c,"d"\n',
        y2006=HEAD.replace("\n", "\r\n") + '1,"x",3\r\n',
        y2007=HEAD + '1,"x\ry",3\n',
        y2008=HEAD + "1,2,3\r4,5,6\n",
    )
    paths = [batch.path for batch in discover(spark, folder)]
    facts = {row.file_name[-8:-4]: row for row in line_facts(spark, paths).collect()}
    assert {year: row.one_line_records for year, row in facts.items()} == {
        "2001": True, "2002": False, "2003": False, "2004": True, "2005": True,
        "2006": True, "2007": False, "2008": False,
    }
    assert [year for year, row in facts.items() if not row.valid_utf8] == ["2004"]


def test_reading_keeps_text_and_positions(spark, tmp_path):
    folder = write(
        tmp_path,
        y2001=HEAD + '1,"x\ny",z\n\n2,,"q ""w"" e"\n   \n3\n',
        y2002=HEAD + '1,5" pipe,"x\ny"\n2,"",3\n',
        y2003=HEAD + '1,"a,b,c,d",NA\n007, 8 ,null\n',
        y2004="﻿" + HEAD + "1,2,3\n",
        y2005=HEAD.replace("\n", "\r\n") + '1,2,3\r\n4,"x\r\ny",6\r\n',
    )
    read = read_batches(spark, discover(spark, folder), ["a", "b", "c"])
    assert read.problems == {}
    assert read.row_counts == {2001: 3, 2002: 2, 2003: 2, 2004: 1, 2005: 2}
    rows = read.rows.orderBy("batch_year", "source_row_number").collect()
    assert [tuple(row) for row in rows] == [
        ("1", "x\ny", "z", 2001, 2),
        ("2", "", 'q "w" e', 2001, 3),
        ("3", "", "", 2001, 4),
        ("1", '5" pipe', "x\ny", 2002, 2),
        ("2", "", "3", 2002, 3),
        ("1", "a,b,c,d", "NA", 2003, 2),
        ("007", " 8 ", "null", 2003, 3),
        ("1", "2", "3", 2004, 2),
        ("1", "2", "3", 2005, 2),
        ("4", "x\r\ny", "6", 2005, 3),
    ]


def spanning_text(seed, end="\n"):
    """Records with quoted delimiters, quotes and line breaks, and quotes inside plain fields."""
    rng = random.Random(seed)
    cells = ["x", "", 'a "q" b', 'say ""', "two\nlines", "\n\n", ',\n"', '5" pipe', "a,b", '"', " y"]
    cells += ["old\rmac", "dos\r\nlines", "\r", "\r\r\n\n", 'q"\r,']
    lines = ["a,b,c"]
    for number in range(400):
        row = [str(number), rng.choice(cells), rng.choice(cells)]
        plain = [c for c in row]
        for index, cell in enumerate(row):
            if set(cell) & set(',\n\r"') and cell != '5" pipe':
                plain[index] = '"' + cell.replace('"', '""') + '"'
        lines.append(",".join(plain))
        if rng.random() < 0.1:
            lines.append("")
    return end.join(lines) + end


def by_python(text):
    """Rows as Python's csv module reads them, with their numbers; blank lines do not count."""
    found = csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline=""))
    rows = [row for row in found if any(cell.strip() for cell in row) or len(row) > 1]
    return [(*row, number) for number, row in enumerate(rows, 1)][1:]


def test_long_records_are_found_in_splits(spark, tmp_path):
    """Files whose records span lines give the rows that Python reads, in splits of any size."""
    texts = {2019: "\ufeff" + spanning_text(1), 2020: spanning_text(2, "\r\n"), 2018: spanning_text(3, "\r")}
    folder = write(
        tmp_path,
        **{f"y{year}": text for year, text in texts.items()},
        y2021=HEAD + '1,"open\n2,3,4\n',
        y2022=HEAD + '1,"x\ny",3,4\n',
    )
    batches = discover(spark, folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    expected = [(*row[:-1], year, row[-1]) for year, text in texts.items() for row in by_python(text)]
    assert len(expected) == 1200
    try:
        for size in ("700", "2500", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            long = read_batches(spark, batches, ["a", "b", "c"])
            found = [tuple(r) for r in long.rows.where("batch_year < 2021").collect()]
            assert sorted(found) == sorted(expected)
            assert sorted(long.problems) == [2021, 2022]
            assert "not closed" in long.problems[2021][0]
            assert "too many fields" in long.problems[2022][0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    ("content", "problem"),
    [
        ("", "no header"),
        (HEAD, "no data rows"),
        ("\n\n", "no header"),
        (HEAD + '1,2,3\n2,"open,3\n3,4,5\n', "not closed"),
        (HEAD + "1,2,3,4\n", "too many fields"),
        (HEAD + "1,2,3,\n", "too many fields"),
        (HEAD + "1,2,3,,5\n", "too many fields"),
        (HEAD + "1,2,3,4,5\n", "too many fields"),
        (HEAD + '1,"2,3",4,,5\n', "too many fields"),
        ("a,B,c\n1,2,3\n", "missing: ['b']; unexpected: ['B']"),
        ("a,c,b\n1,2,3\n", "missing: []; unexpected: []"),
        ("a,b\n1,2\n", "missing: ['c']"),
        ("a,b,c,d\n1,2,3\n", "unexpected: ['d']"),
        (HEAD.encode() + b"1,\xff\xfe,3\n", "does not decode"),
    ],
)
def test_faulty_files(spark, tmp_path, content, problem):
    folder = write(tmp_path, y2019=content, y2020=HEAD + "1,2,3\n")
    read = read_batches(spark, discover(spark, folder), ["a", "b", "c"])
    assert list(read.problems) == [2019]
    assert any(problem in text for text in read.problems[2019])
    assert [row.a for row in read.rows.where("batch_year = 2020").collect()] == ["1"]


def test_other_encoding_and_delimiter(spark, tmp_path):
    texts = {"y2019": "a;b;c\n1;é;3\n", "y2020": 'a;b;c\n1;"ü\n;";3\n'}
    folder = write(tmp_path, **{year: text.encode("latin-1") for year, text in texts.items()})
    for name in ("ISO-8859-1", "latin-1", "latin1"):
        read = read_batches(
            spark, discover(spark, folder), ["a", "b", "c"], encoding=name, delimiter=";"
        )
        assert read.problems == {}
        assert sorted(row.b for row in read.rows.collect()) == ["é", "ü\n;"]


@pytest.mark.parametrize(
    ("encoding", "good", "bad"),
    [
        ("utf8", "é".encode(), b"\xe9"),
        ("ascii", b"e", "é".encode()),
        ("utf-16", "\ufeff".encode("utf-16-le"), b"\x00"),
        ("utf-16-be", b"", b"\xd8\x00\x00\x41"),
    ],
)
def test_wrongly_encoded_files(spark, tmp_path, encoding, good, bad):
    wide = {"utf-16": "utf-16-le"}.get(encoding, encoding)
    text = (HEAD + '1,"x\r\ny",3\n').encode(wide)
    first = good + text if encoding == "utf-16" else text + good * (encoding == "utf8")
    folder = write(tmp_path, y2019=first, y2020=(good + text if encoding == "utf-16" else text) + bad)
    read = read_batches(spark, discover(spark, folder), ["a", "b", "c"], encoding=encoding)
    assert list(read.problems) == [2020]
    assert "does not decode" in read.problems[2020][0]
    assert "x\r\ny" in [row.b for row in read.rows.where("batch_year = 2019").collect()]


def test_unknown_encodings(spark, tmp_path):
    folder = write(tmp_path, y2019=HEAD + "1,2,3\n")
    for name in ("nonsense", None, "utf-7", "iso2022_jp", "hz", "rot13", "base64", "unicode_escape", "idna"):
        with pytest.raises(ValueError, match="unsupported encoding"):
            read_batches(spark, discover(spark, folder), ["a", "b", "c"], encoding=name)


ODD = "\u0a41\u0041\u0a00\u000b\u0a0a\u0d0d\u0a0d\u0d0a\u2028\u0a00\u0a41"  # bytes of line feeds across code units


@pytest.mark.parametrize(
    ("encoding", "letters", "size"),
    [
        ("utf-16", ODD + "é\U0001f389", "700"),
        ("utf-16-be", ODD, "2500"),
        ("utf-32", ODD, None),
        ("utf-32-be", ODD, "2500"),
        ("cp1252", "€é’", "2500"),
        ("cp437", "é░", None),
        ("iso8859-15", "€é", None),
        ("gb18030", "漢€\u0a41\U0001f389", "2500"),
        ("shift_jis", "漢字カ", None),
        ("cp037", "é", None),
    ],
)
def test_other_encodings_are_read_in_splits(spark, tmp_path, encoding, letters, size):
    """The rows that Python reads, also where the bytes of a line feed stand inside characters."""
    rng = random.Random(encoding)

    def salted(seed, end):
        text = spanning_text(seed, end)
        return "".join(c + (rng.choice(letters) if c in "xyz4" else "") for c in text)

    texts = {2019: salted(1, "\n"), 2020: salted(2, "\r\n"), 2018: salted(3, "\r"), 2017: HEAD + letters * 900 + ",1,2"}
    contents = {f"y{year}": text.encode(encoding) for year, text in texts.items()}
    if encoding == "utf-16":
        contents["y2020"] = ("\ufeff" + texts[2020]).encode("utf-16-be")
    folder = write(tmp_path, **contents, y2021=(HEAD + '1,"open\n2,3,4\n').encode(encoding))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size or before)
    try:
        read = read_batches(spark, discover(spark, folder), ["a", "b", "c"], encoding=encoding)
        assert list(read.problems) == [2021] and "not closed" in read.problems[2021][0]
        expected = [(*row[:-1], year, row[-1]) for year, text in texts.items() for row in by_python(text)]
        assert len(expected) == 1201
        assert sorted(tuple(r) for r in read.rows.where("batch_year <> 2021").collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    ("encoding", "bad"),
    [
        ("cp1252", b"\x81"), ("gb18030", b"\xff"), ("utf-16-le", b"\x00\xd8"), ("utf-32-le", b"\x00\x00\x11"),
        ("utf-16-le", b"\n"), ("shift_jis", b"\x81"),
    ],
)
def test_bytes_that_are_no_text_in_other_encodings(spark, tmp_path, encoding, bad):
    text = "".join(f"{i},x{i},y\n" for i in range(300))
    content = (HEAD + text).encode(encoding)
    at = len(HEAD.encode(encoding)) + len("0,x".encode(encoding))
    with pytest.raises(UnicodeDecodeError):
        (content[:at] + bad + content[at:]).decode(encoding)
    folder = write(tmp_path, y2019=content, y2020=content[:at] + bad + content[at:], y2021=content + bad)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        read = read_batches(spark, discover(spark, folder), ["a", "b", "c"], encoding=encoding)
        assert sorted(read.problems) == [2020, 2021]
        assert all("does not decode" in texts[0] for texts in read.problems.values())
        assert read.rows.where("batch_year = 2019").count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_too_long_to_be_a_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(long_records_module, "LONGEST_RECORD", 50)
    folder = write(tmp_path, y2019=HEAD + '1,"x\ny",3\n2,"' + "x\n" * 40 + '",3\n', y2020=HEAD + '1,"a\nb",3\n')
    read = read_batches(spark, discover(spark, folder), ["a", "b", "c"])
    assert list(read.problems) == [2019] and "record 3 is too long" in read.problems[2019][0]
    assert [row.b for row in read.rows.where("batch_year = 2020").collect()] == ["a\nb"]


def test_split_files_keep_their_row_numbers(spark, tmp_path, monkeypatch):
    text = HEAD + "".join(f'{i},"x{i}, y",z\n' for i in range(4000))
    folder = write(tmp_path, y2019=text, y2020=text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        for limit in (lookup.MAX_BROADCAST_GROUPS, 1):
            monkeypatch.setattr(lookup, "MAX_BROADCAST_GROUPS", limit)
            read = read_batches(spark, discover(spark, folder), ["a", "b", "c"])
            wrong = read.rows.where("cast(a AS bigint) + 2 <> source_row_number").count()
            assert (read.rows.count(), wrong) == (8000, 0)
        assert spark.read.text(folder).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_numbering_by_key_spreads_a_batch(spark):
    frame = spark.sql(
        "SELECT cast(2019 + id % 3 % 2 AS smallint) AS y, id DIV 4 AS k, id FROM range(0, 2000)"
    ).repartition(5)
    numbered = number_rows(frame, batch="y", order=["k", "id"])
    rows = sorted(numbered.collect(), key=lambda row: (row.y, row.id))
    for year in (2019, 2020):
        numbers = [row.source_row_number for row in rows if row.y == year]
        assert numbers == list(range(2, len(numbers) + 2))
    plan = numbered._jdf.queryExecution().toString()
    assert "Window" not in plan.split("== Physical Plan ==")[1] or "Scan ExistingRDD" in plan


def test_content_fingerprint_ignores_row_order(spark):
    frame = spark.sql("SELECT 1S AS y, id, cast(id AS string) AS t FROM range(0, 100)")
    once = content_fingerprint(frame, ["id", "t"], batch="y").collect()
    again = content_fingerprint(frame.orderBy("t").repartition(3), ["id", "t"], batch="y").collect()
    other = content_fingerprint(frame.where("id <> 5"), ["id", "t"], batch="y").collect()
    assert once == again != other


def _stored_names(monkeypatch, *modules):
    """The names of the tables that modules store from now on."""
    names = []
    for module in modules:
        kept = module.stored
        monkeypatch.setattr(module, "stored", lambda df, name, kept=kept: (names.append(name), kept(df, name))[1])
    return names


def test_reading_hashes_no_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "food_inspections_2020.csv").write_bytes(b'a,b\n1,"x"\n2,y\r\n')
    batch = locate_batch(spark, str(tmp_path / "food_inspections_2020.csv"), start_year=2020, end_year=2020)
    names = _stored_names(monkeypatch, batches_module, csv_batches)
    read = csv_batches.read_batches(spark, [batch], ["a", "b"])
    assert [tuple(row)[:2] for row in read.rows.orderBy("source_row_number").collect()] == [("1", "x"), ("2", "y")]
    assert names == ["records"]


@pytest.mark.parametrize("encoding", ["utf-16", "cp1252"])
def test_decoded_lines_are_kept_once(spark, tmp_path, monkeypatch, encoding):
    path = tmp_path / "food_inspections_2020.csv"
    path.write_bytes('a\n"é\r\nü"\r\n\n\u0178\n'.encode(encoding))
    batch = locate_batch(spark, str(path), start_year=2020, end_year=2020)
    names = _stored_names(monkeypatch, decoding)
    read = csv_batches.read_batches(spark, [batch], ["a"], encoding=encoding)
    assert [row.a for row in read.rows.orderBy("source_row_number").collect()] == ["é\r\nü", "\u0178"]
    assert "decoded_lines" not in names


def test_lines_decoded_together_are_those_decoded_alone():
    charset = find_encoding("utf-16-le")
    pieces = [text.encode("utf-16-le") for text in ("a", "", "b\rc\r", "é")]
    made = decoding._Made()
    for piece in pieces:
        made.line("f", 0, piece, charset.python, False)
    assert decoding._many(("f", 0), decoding._whole_lines(pieces, charset)).equals(made.take())
    assert decoding._whole_lines([b"a", b"b"], charset) is None  # cuts inside of code units
    assert decoding._whole_lines([b"\x00\xd8"], charset) is None


def test_hashes_of_lines_are_kept_in_runs(spark, tmp_path, monkeypatch):
    kept = {}

    def spy(df, name, store=batches_module.stored):
        kept[name] = store(df, name)
        return kept[name]

    monkeypatch.setattr(batches_module, "stored", spy)
    contents = {2001: b"a,b,c\n" + b"1,2,3\n" * 5000, 2002: b"one line"}
    folder = write(tmp_path, **{f"y{year}": content for year, content in contents.items()})
    found = {r.batch_year: r.checksum for r in inspect_batches(spark, discover(spark, folder)).collect()}
    assert found == {year: tree_by_hand(content, 1024) for year, content in contents.items()}
    # 5,001 lines come to 5 rows, and one line to one.
    assert sorted(row.lines for row in kept["line_hashes"].select("lines").collect()) == [1, 905, 1024, 1024, 1024, 1024]
