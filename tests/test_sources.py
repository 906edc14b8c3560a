import json
import random

import pyarrow as pa
import pytest

from starmill.sources import documents, records
from starmill.sources.csv import read_csv, read_csv_directory
from starmill.sources.extract import extract, union_by_name
from starmill.sources.generate import generate_sales
from starmill.sources.json import document_order, read_json
from starmill.sources.sql import list_tables, read_query, read_table
from starmill.streaming.ingest import stream_csv


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def values(df, *columns):
    return [tuple(r) for r in df.orderBy("_ord").select(*columns).collect()]


def test_csv_cells_are_text_with_lineage(spark, tmp_path):
    df = read_csv(spark, write(tmp_path / "people.csv", "id,name,age\n1,Ann,25\n2,Bo,030\n"))
    assert values(df, "id", "age") == [("1", "25"), ("2", "030")]
    assert values(df, "_source_file", "_source_type") == [("people.csv", "CSV")] * 2


def test_csv_reads_spellings_of_nothing_as_null(spark, tmp_path):
    text = 'a,b\nNULL,x\nN/A,-\n"",none\n  nan ,<NA>\n'
    df = read_csv(spark, write(tmp_path / "n.csv", text))
    assert values(df, "a", "b") == [
        (None, "x"), (None, "-"), (None, "none"), ("  nan ", None),
    ]


def test_csv_quotes_line_breaks_and_delimiter(spark, tmp_path):
    text = 'a;b\n"x;""y""";"two\nlines"\n'
    df = read_csv(spark, write(tmp_path / "q.csv", text), delimiter=";")
    assert values(df, "a", "b") == [('x;"y"', "two\nlines")]


def test_csv_encoding(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("a\ncafé\n".encode("latin-1"))
    df = read_csv(spark, str(tmp_path / "l.csv"), encoding="latin-1")
    assert values(df, "a") == [("café",)]


def test_missing_files_raise(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        read_json(spark, str(tmp_path / "none.json"))
    with pytest.raises(NotADirectoryError):
        read_csv_directory(spark, str(tmp_path / "nowhere"))


def test_csv_directory_unites_headers(spark, tmp_path):
    write(tmp_path / "a.csv", "id,name\n1,x\n")
    write(tmp_path / "b.CSV", "name,id,more\ny,2,z\n")
    write(tmp_path / "c.csv", "id,name\n3,w\n")
    write(tmp_path / "d.txt", "id,name\n4,v\n")
    df = read_csv_directory(spark, str(tmp_path))
    assert sorted(values(df, "id", "name", "more")) == [
        ("1", "x", None), ("2", "y", "z"), ("3", "w", None),
    ]
    assert read_csv_directory(spark, write_empty(tmp_path)) is None


def write_empty(tmp_path):
    (tmp_path / "empty").mkdir()
    return str(tmp_path / "empty")


def test_file_order_survives_many_splits(spark, tmp_path):
    for n in range(3):
        rows = "\n".join(f"{n},{i}" for i in range(20000))
        write(tmp_path / f"part{n}.csv", f"file,row\n{rows}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50000)
    try:
        df = read_csv_directory(spark, str(tmp_path), multiline=False)
        assert df.rdd.getNumPartitions() > 6
        found = [tuple(map(int, r)) for r in values(df.repartition(7), "file", "row")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(n, i) for n in range(3) for i in range(20000)]


def test_large_files_are_split_even_where_a_cell_spans_lines(spark, tmp_path):
    lines = [f'{i},"say ""{i}"", ok"' for i in range(20000)]
    plain = write(tmp_path / "plain.csv", "\n".join(["n,t", *lines]) + "\n")
    lines[777] = '777,"two\nlines"'
    spans = write(tmp_path / "spans.csv", "\n".join(["n,t", *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100000)
    try:
        split, whole = read_csv(spark, plain), read_csv(spark, spans)
        assert split.rdd.getNumPartitions() > 1 and whole.rdd.getNumPartitions() > 1
        assert split.count() == whole.count() == 20000
        assert whole.where("n = 777").first()["t"] == "two\nlines"
        assert values(split, "n")[19999] == ("19999",)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_array_object_and_other_roots(spark, tmp_path):
    array = write(tmp_path / "a.json", json.dumps([{"id": 1, "p": "x"}, {"id": 2, "p": "y"}]))
    assert values(read_json(spark, array), "id", "p", "_source_type") == [
        (1, "x", "JSON"), (2, "y", "JSON"),
    ]
    one = write(tmp_path / "o.json", json.dumps({"id": 7}))
    assert values(read_json(spark, one), "id") == [(7,)]
    with pytest.raises(Exception):
        read_json(spark, write(tmp_path / "s.json", '"text"')).collect()
    with pytest.raises(Exception):
        read_json(spark, write(tmp_path / "bad.json", '{"id": ')).collect()


def test_json_columns_keep_written_order(spark, tmp_path):
    doc = [{"z": 1, "in": {"y": 2, "deep": {"x": 3}}, "a": [1, 2]}]
    df = read_json(spark, write(tmp_path / "d.json", json.dumps(doc)))
    assert df.columns[:4] == ["z", "a", "in.y", "in.deep.x"]
    assert values(df, "`in.deep.x`", "a") == [(3, [1, 2])]
    assert document_order(doc[0]) == ["z", "a", "in.y", "in.deep.x"]


def test_json_records_below_a_path(spark, tmp_path):
    doc = {
        "shop": "s", "at": {"city": "Oran"},
        "data": {"items": [{"n": 1, "box": {"w": 5}}, {"n": 2, "box": {"w": 6}}]},
    }
    path = write(tmp_path / "r.json", json.dumps(doc))
    df = read_json(
        spark, path, record_path=["data", "items"], meta=["shop", ["at", "city"], "none"]
    )
    assert values(df, "n", "`box.w`", "shop", "`at.city`", "none") == [
        (1, 5, "s", "Oran", None), (2, 6, "s", "Oran", None),
    ]
    array = write(tmp_path / "arr.json", json.dumps([{"n": 1, "items": [1]}]))
    assert values(read_json(spark, array, record_path="items"), "n", "items") == [(1, [1])]


def test_several_json_files(spark, tmp_path):
    a = write(tmp_path / "a.json", '[{"id": 1}]')
    b = write(tmp_path / "b.json", '[{"id": 2, "more": "m"}]')
    assert values(read_json(spark, [a, b]), "id", "more") == [(1, None), (2, "m")]


def test_sql_sources(spark):
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string").createOrReplaceTempView("t_src")
    assert read_table(spark, "t_src", "id > 1").count() == 2
    rows = read_query(spark, "SELECT * FROM t_src WHERE id = ?", [2])
    assert [r["v"] for r in rows.collect()] == ["b"]
    assert rows.first()["_source_type"] == "SQL"
    assert values(read_table(spark, "t_src", order_by=["v"]), "v") == [("a",), ("b",), ("c",)]
    assert "t_src" in [r["table_name"] for r in list_tables(spark).collect()]


def test_extract_unites_and_records_failures(spark, tmp_path):
    csv = write(tmp_path / "c.csv", "id,name\n1,x\n")
    doc = write(tmp_path / "p.json", '[{"id": 5, "price": 2.5}]')
    spec = {"sources": [
        {"type": "csv", "path": csv},
        {"type": "CSV", "path": str(tmp_path / "gone.csv")},
        {"type": "parquet", "path": "x"},
        {"type": "JSON", "path": doc},
        {"type": "SQL"},
    ]}
    found = extract(spark, spec)
    assert values(found.rows, "id", "name", "price") == [("1", "x", None), ("5", None, 2.5)]
    assert len(found.failed) == 2
    with pytest.raises(FileNotFoundError):
        extract(spark, {**spec, "validation_mode": "strict"})
    assert extract(spark, {"sources": []}).rows is None


def test_union_makes_disputed_types_text(spark):
    a = spark.createDataFrame([(1,)], "v long")
    b = spark.createDataFrame([(2.5,)], "v double")
    assert sorted(r["v"] for r in union_by_name([a, b]).collect()) == ["1", "2.5"]


def test_generated_sales_add_up_and_repeat(spark):
    rows = generate_sales(spark, 500)
    found = rows.collect()
    assert found == generate_sales(spark, 500).repartition(5).orderBy("order_id").collect()
    assert len({r["order_id"] for r in found}) == 500
    for r in found:
        assert 1 <= r["quantity"] <= 5 and 10 <= r["unit_price"] <= 2000
        exact = r["quantity"] * r["unit_price"] * (100 - r["discount"]) / 100
        assert abs(r["total_amount"] - exact) <= 0.005 + 1e-9 if isinstance(exact, float) else True
    assert len({r["country"] for r in found}) == 5


@pytest.mark.parametrize("content", [
    "n,t\n1,a\rb\n2,c\n", "n,t\n1,a\n   \n2,c\n", 'n,t\n1,"a\nb"\n2,c\n', "n,t\r\n1,a\r\n2,c\r\n",
])
def test_rows_do_not_depend_on_the_size_of_a_task(spark, tmp_path, content):
    path = write(tmp_path / "f.csv", content + "".join(f"{k},x\n" for k in range(3, 40)))
    found = []
    for limit in ("64", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        try:
            found.append(sorted(map(repr, read_csv(spark, path).select("n", "t").collect())))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1]


def cells_of(text):
    """Rows of a CSV text, a character at a time; text that follows a closing quote is not made here."""
    rows, row, cell, state = [], [], "", "start"
    i = 0
    while i <= len(text):
        c = text[i:i + 1]
        if state == "quoted" and c:
            if text.startswith('""', i):
                cell, i = cell + '"', i + 2
                continue
            if c == '"':
                state = "closed"
            else:
                cell += c
        elif c == '"' and state == "start":
            state = "quoted"
        elif c in (",", "\r", "\n", ""):
            row, cell, state = [*row, cell], "", "start"
            if c != ",":
                if row != [""] and (len(row) > 1 or row[0].strip()):
                    rows.append([v or None for v in row])
                row = []
        else:
            cell, state = cell + c, "plain"
        i += 1
    return rows


def odd_text(rng, lines, quoted):
    kinds = ["x", "long cell", 'a "q" b', 'pipe 5"', " ", "é–\U0001f600", ""]
    spans = ['"two\nlines"', '"crlf\r\n, and ""quotes"""', '"\r"', '"' + "\n" * 30 + '"', '"a,b"', '"",""', '"\n,\n"']
    out = []
    for i in range(lines):
        cells = [str(i), *(rng.choice(spans if rng.random() < quoted else kinds) for _ in range(2))]
        out.append(",".join(cells) + rng.choice(["\n", "\r\n", "\r", "\n \n"]))
    return "a,b,c\n" + "".join(out)


@pytest.mark.parametrize("quoted", [0.0, 0.05, 0.7])
def test_rows_of_odd_texts_at_any_size_of_a_task(spark, tmp_path, quoted):
    rng = random.Random(7)
    text = odd_text(rng, 120, quoted)
    (tmp_path / "f.csv").write_bytes(text.encode())
    want = [r[:3] + [None] * (3 - len(r)) for r in cells_of(text)[1:]]
    want = [[None if v in ("", "N/A") else v for v in r] for r in want]
    for limit in ("61", "400", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        try:
            rows = read_csv(spark, str(tmp_path / "f.csv")).orderBy("_ord").select("a", "b", "c").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [list(r) for r in rows] == want


def test_a_line_break_in_one_cell_leaves_other_rows_alone(spark, tmp_path):
    lines = "n,t\n1,x\ry\n   \n2,plain\n"
    one, two = write(tmp_path / "one.csv", lines), write(tmp_path / "two.csv", lines + '3,"a\nb"\n')
    rows = values(read_csv(spark, one), "n", "t")
    assert rows == [("1", "x"), ("y", None), ("2", "plain")]
    assert values(read_csv(spark, two), "n", "t") == [*rows, ("3", "a\nb")]


def test_a_quote_that_nothing_closes(spark, tmp_path):
    text = "n,t\n" + "".join(f"{i},x\n" for i in range(50)) + '50,"open\n' + "51,y\n" * 40
    found = []
    for limit in ("64", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        try:
            found.append(values(read_csv(spark, write(tmp_path / "q.csv", text)), "n", "t"))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] and len(found[0]) == 51
    assert found[0][50][1].rstrip("\n") == "open\n" + "\n".join(["51,y"] * 40)


def test_streams_and_batches_read_the_same_rows(spark, tmp_path):
    rng = random.Random(11)
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        (folder / f"{n}.csv").write_bytes(odd_text(rng, 60, 0.3).encode())
    query = (
        stream_csv(spark, str(folder), ["a", "b", "c"]).writeStream.format("memory").queryName("same_rows")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    columns = ["a", "b", "c", "_source_file"]
    streamed = sorted(map(repr, spark.table("same_rows").select(columns).collect()))
    assert streamed == sorted(map(repr, read_csv(spark, str(folder)).select(columns).collect()))
    assert len(streamed) == 180


def test_a_header_of_two_lines_and_a_mark(spark, tmp_path):
    (tmp_path / "h.csv").write_bytes("\ufeff\n\"first\nname\",b\nx,y\n".encode())
    df = read_csv(spark, str(tmp_path / "h.csv"))
    assert df.columns[:2] == ["first\nname", "b"]
    assert [tuple(r)[:2] for r in df.collect()] == [("x", "y")]


def test_a_folder_is_read_by_each_files_header(spark, tmp_path):
    write(tmp_path / "a.csv", "id,amt\n1,10\n")
    write(tmp_path / "b.csv", "amt,id\n200,2\n")
    write(tmp_path / "c.txt", "id,amt\n9,9\n")
    assert sorted(values(read_csv(spark, str(tmp_path)), "id", "amt")) == [("1", "10"), ("2", "200")]
    with pytest.raises(Exception, match="columns of .*b.csv are not those of the first file"):
        read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()


def test_sql_options_of_a_spec(spark):
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string").createOrReplaceTempView("t_spec")
    spec = {"sources": [
        {"type": "SQL", "table": "t_spec", "where": "id > 2"},
        {"type": "SQL", "query": "SELECT * FROM t_spec WHERE id = ?", "params": [1]},
    ]}
    assert sorted(values(extract(spark, spec).rows, "id", "v")) == [(1, "a"), (3, "c")]


def odd_records(rng, n):
    texts = ["x", 'a "q", b', "back\\slash\\", "br[ack}ets,", "é–\U0001f600", "", ",,,", "two\nlines", "\\\\\"," * 9]
    return [
        {
            "id": i, "t": rng.choice(texts), "n": rng.choice([None, 1.5, -2.0]),
            "in": {"a": rng.choice(texts), "list": [rng.choice(texts) for _ in range(rng.randrange(4))]},
        }
        for i in range(n)
    ]


LAYOUTS = [{}, {"indent": 2}, {"separators": (",", ":"), "ensure_ascii": False}]


def cut_apart(text, rng, blocks):
    """Elements of a document whose blocks begin after commas picked at random, put together without Spark."""
    values = text.split(",")
    at = sorted(rng.sample(range(1, len(values)), min(blocks, len(values)) - 1))
    of_block = [sum(a <= i for a in at) * 10 for i in range(len(values))]
    rows = pa.table({"value": values, "file": ["f"] * len(values), "name": ["f"] * len(values), "block": of_block})
    batches = rows.to_batches(max_chunksize=rng.randrange(1, 20))
    starts = documents.compose(pa.Table.from_batches(documents.summaries(batches))).to_pylist()
    before = {("f", r["block"]): (r["inside"], r["depth"]) for r in starts}
    found = pa.Table.from_batches(documents.elements(batches, before)).to_pylist()
    out = []
    for r in found:
        if r["whole"] or r["begins"]:
            out.append(r["record"])
        else:
            out[-1] += r["record"]
    return [json.loads(x) for x in out]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_json_elements_wherever_blocks_begin(layout):
    rng = random.Random(5)
    for n in [*range(1, 12)] * 6:
        records = odd_records(rng, n)
        root = records if rng.random() < 0.8 else records[0]
        text = "\n " + json.dumps(root, **layout) + " \n"
        want = root if isinstance(root, list) else [root]
        assert cut_apart(text, rng, rng.randrange(1, 30)) == want
    assert cut_apart("[1, [2, 3], \"a,]\", null]", rng, 9) == [1, [2, 3], "a,]", None]
    assert cut_apart("[ \n ]", rng, 1) == []


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1},,{"a": 2}]', '[{"a": 1}] x', '[{"a": "1}]', "[1]]", "[,1]", "[1,]"])
def test_broken_json_is_never_rows(text):
    with pytest.raises(ValueError):
        cut_apart(text, random.Random(3), 2)


@pytest.mark.parametrize("layout", LAYOUTS[1:])
def test_json_rows_at_any_size_of_a_task(spark, tmp_path, layout):
    rng = random.Random(11)
    records = odd_records(rng, 60)
    records[7] = records[7] | {"t": "one, long, " * 1500}
    path = write(tmp_path / "f.json", "\n " + json.dumps(records, **layout) + " \n")
    want = [(r["id"], r["t"], r["n"], r["in"]["a"], r["in"]["list"]) for r in records]
    for limit in ("5000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        try:
            df = read_json(spark, path)
            assert df.columns[:5] == ["id", "t", "n", "in.a", "in.list"]
            assert [tuple(r)[:6] for r in df.orderBy("_ord").collect()] == [(*w, "f.json") for w in want]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_large_json_array_is_read_by_many_tasks(spark, tmp_path):
    records = [{"id": i, "t": f"text {i}, " * 5} for i in range(20000)]
    files = [write(tmp_path / "a.json", json.dumps(records)), write(tmp_path / "o.json", json.dumps({"id": -1, "t": "one"}))]
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200000)
    try:
        assert documents.pieces(spark, files).rdd.getNumPartitions() > 6
        df = read_json(spark, files)
        assert values(df, "id", "t") == [(r["id"], r["t"]) for r in records] + [(-1, "one")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n", "a\n\n", "\n\na\nbb\n\nccc", 'h\n"x\n\n', "one line that is longer\nb\n"])
def test_lines_of_a_text_come_in_groups(text):
    whole = text.removesuffix("\n").split("\n")
    for most in (0, 1, 3, 1000):
        groups = list(records.line_groups(text, most))
        assert [line for group in groups for line in group] == whole
        assert all(sum(map(len, group[:-1])) <= most for group in groups)


def test_a_file_of_a_stream_is_not_held_as_records(spark, tmp_path):
    cells = "".join(f'{n},"two\nlines"\n' for n in range(60_000))
    (tmp_path / "one.csv").write_text(f"n,t\n{cells}")
    sizes = []

    class Seen(records.Block):
        def taken(self, parts):
            out = super().taken(parts)
            sizes.append(out.num_rows)
            return out

    text = (tmp_path / "one.csv").read_text()
    block = Seen("f", "f", 0, records.Blocks(), ",", None)
    for lines in records.line_groups(text, 1 << 16):
        block.add(pa.array(lines, pa.string()))
        block.taken(False)
    block.finish()
    block.taken(False)
    assert sum(sizes) == 60_000 and max(sizes) < 6_000
