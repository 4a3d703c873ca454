import pytest
from pyspark.sql import functions as F

from placemill import vocab
from placemill.operators import registers as R
from placemill.plans.registers import harmonised_rows, merged_register
from placemill.sources.registers import decode_text, scan_registers, scan_utf8_csv
from placemill.sources.registry import KNOWN_AREAS, SourceSpec, known_registers
from placemill.sources.xlsx import sheet_rows
from placemill_checks.frames import workbook

HEADER = "屋号,業種, 許可日 ,住所1,住所2,緯度,経度"
BODY = ['"髙橋\n商店①",飲食, R2.4.1 ,"東京, 都 ",　,35.5,139.5', "　,菓子,45212,,,,", '"引用""符",飲食,nan,A,B, ,1', ",x,,,,,"]
COLMAP = {"name": "屋号", "business_type": "業種", "license_date": "許可日", "lat": "緯度", "lng": "経度", "phone": "電話"}


def spec(id, path, **kw):
    kw = {"const": {"city": "C"}, "colmap": COLMAP, "address_parts": ("住所1", "無い列", "住所2"), "format": "csv", **kw}
    return SourceSpec(id, "P", "M", "own", f"Source {id}", "CC BY 4.0", path=str(path), **kw)


def test_encoding_rule():
    text = "髙①屋号,a"
    assert decode_text(b"\xef\xbb\xbf" + text.encode(), None) == text
    assert decode_text(text.encode(), None) == text
    assert decode_text(text.encode("cp932"), None) == text
    assert decode_text(b"\x81", "cp932") == "�"
    assert decode_text("é".encode("latin-1"), "latin-1") == "é"


@pytest.fixture
def files(tmp_path):
    text = "\r\n".join([HEADER, *BODY]) + "\r\n"
    rows = [["題名"], [c for c in HEADER.split(",")], ["髙橋\n商店①", "飲食", " R2.4.1 ", "東京, 都 ", "　", "35.5", "139.5"],
            ["　", "菓子", "45212"], [], ['引用"符', "飲食", "nan", "A", "B", " ", "1"], ["", "x"]]
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    (tmp_path / "sjis.csv").write_bytes(text.encode("cp932"))
    (tmp_path / "titled.csv").write_bytes(("題名,,\r\n" + text).encode("cp932"))
    (tmp_path / "book.xlsx").write_bytes(workbook(rows, "一覧"))
    return [
        spec("bom", tmp_path / "bom.csv", encoding="utf-8-sig"), spec("sjis", tmp_path / "sjis.csv"),
        spec("titled", tmp_path / "titled.csv", format="fas", encoding="cp932", header_row=1),
        spec("book", tmp_path / "book.xlsx", format="excel", header_row=1, sheet="一覧"),
    ]


def test_all_layouts_give_the_same_rows(spark, files):
    rows = harmonised_rows(spark, files).orderBy("source_rank", "row_pos").collect()
    want = [("髙橋\n商店①", "飲食", "東京, 都", "2020-04-01", "35.5", "139.5", "source", "C", "C"),
            ('引用"符', "飲食", "A B", "", "", "1", "", "C", "C")]
    fields = ("name", "business_type", "address", "license_date", "lat", "lng", "geocoding_level", "city", "city_raw")
    for i, s in enumerate(files):
        got = [r for r in rows if r.srcid == s.id]
        assert [tuple(r[f] for f in fields) for r in got] == want, s.id
        assert {(r.source_rank, r.sources, r.licenses) for r in got} == {(i, f"Source {s.id}", "CC BY 4.0")}
    merged = merged_register(spark, files).orderBy("first_seen").collect()
    assert [r.srcid for r in merged] == ["bom,book,sjis,titled"] * 2
    assert merged[0].sources == "Source bom; Source book; Source sjis; Source titled"


def test_missing_columns_are_reported(spark, files):
    records = scan_registers(spark, files)
    got = {tuple(r) for r in R.missing_columns(records, files).collect()}
    assert got == {(s.id, "phone", "電話") for s in files}


def test_native_reader_agrees_with_the_decoder(spark, files):
    native = scan_utf8_csv(spark, files[0].path).withColumn("row_pos", F.monotonically_increasing_id())
    with pytest.warns(UserWarning, match="電話"):
        a = R.normalize_frame(native, files[0], 0)
    b = harmonised_rows(spark, files[:1])
    assert a.columns == b.columns
    key = lambda df: sorted(map(tuple, df.select(*vocab.REGISTER_COLUMNS).collect()))
    assert key(a) == key(b)


def test_order_of_rules(spark):
    frame = spark.createDataFrame([(0, "n", "mapped", "2024/1/2")], "row_pos long, n string, a string, d string")
    s = spec("s", "/x", colmap={"name": "n", "address": "a", "license_date": "d"}, address_parts=(),
             const={"address": "fixed", "expire_date": "R2.1.1", "city": "C", "sources": "never"})
    row = R.normalize_frame(frame, s).first()
    assert (row.address, row.expire_date, row.license_date, row.city_raw, row.sources) == (
        "fixed", "2020-01-01", "2024-01-02", "C", "Source s")
    s = spec("s", "/x", colmap={"name": "n", "address": "a"}, address_parts=("d",), const={})
    assert R.normalize_frame(frame, s).first().address == "2024/1/2"


def register(spark, rows):
    columns = ", ".join(f"{c} string" for c in vocab.REGISTER_COLUMNS) + ", srcid string, source_rank long, row_pos long"
    full = [tuple(r.get(c, "") for c in vocab.REGISTER_COLUMNS) + (r["srcid"], r["rank"], r["pos"]) for r in rows]
    return spark.createDataFrame(full, columns)


def test_merge_first_row_wins_and_provenance_is_sorted(spark):
    rows = register(spark, [
        dict(name="A 店", address="1", phone="second", srcid="z", sources="Z", licenses="L", rank=1, pos=0),
        dict(name="A　店", address=" 1", phone="first", srcid="y", sources="B; C", licenses="L", rank=0, pos=9),
        dict(name="A店", address="1", phone="third", srcid="y", sources="A", licenses="K", rank=1, pos=5),
        dict(name="A店", address="1", business_type="x", srcid="y", sources="A", licenses="K", rank=0, pos=1),
        dict(name="b", srcid="p", sources="P", licenses="K", rank=2, pos=0),
        dict(name="a", srcid="q", sources="Q", licenses="K", rank=2, pos=1),
    ])
    merged = R.merge_register(rows)
    got = [(r.name, r.phone, r.sources, r.licenses, r.srcid, r.n_rows) for r in R.in_encounter_order(merged).collect()]
    assert got[0] == ("A店", "", "A", "K", "y", 1)
    assert got[1] == ("A　店", "first", "A; B; C; Z", "K; L", "y,z", 3)
    assert [g[0] for g in got[2:]] == ["b", "a"]
    assert tuple(R.merge_summary(merged).first()) == (6, 4, 2)


def test_key_joins_with_a_bar_so_shifted_fields_coincide(spark):
    rows = register(spark, [dict(name="a|b", address="c", business_type="d", srcid="p", rank=0, pos=0),
                            dict(name="a", address="b|c", business_type="d", srcid="p", rank=0, pos=1)])
    assert R.merge_register(rows).count() == 1


def test_merging_again_changes_nothing(spark):
    rows = register(spark, [dict(name=f"n{i % 5}", address="1", srcid=f"s{i % 3}", sources=f"S{i % 3}", rank=i % 3, pos=i) for i in range(30)])
    once = R.merge_register(rows)
    again = R.merge_register(once.withColumns({"source_rank": F.col("first_seen.source_rank"), "row_pos": F.col("first_seen.row_pos")}))
    columns = [*vocab.REGISTER_COLUMNS, "srcid"]
    assert sorted(map(tuple, once.select(columns).collect())) == sorted(map(tuple, again.select(columns).collect()))


def test_reports(spark):
    merged = R.merge_register(register(spark, [
        dict(name="a", phone="1", srcid="minato", rank=0, pos=0), dict(name="b", phone=" ", srcid="kobe", rank=1, pos=0),
        dict(name="b", srcid="fas_kobe", rank=2, pos=0), dict(name="c", srcid="kobe", rank=1, pos=1)]))
    rates = {r.column_name: r.filled_pct for r in R.column_completeness(merged).collect()}
    assert len(rates) == 16 and rates["name"] == 100.0 and rates["phone"] == 33.3333 and rates["lat"] == 0.0
    areas = {r.area: (r.reference, r.n, r.match_pct) for r in R.area_match_rate(merged, KNOWN_AREAS).collect()}
    assert areas["神戸市"] == (29795, 2, 0.0067) and areas["港区"] == (None, 1, None) and areas["前橋市"] == (5370, 0, 0.0)


def test_source_counts_list_silent_sources(spark):
    specs = [spec("a", "/a"), spec("b", "/b")]
    rows = register(spark, [dict(name="x", srcid="a", rank=0, pos=0)])
    got = {(r.source, r.records, r.avail) for r in R.source_counts(rows, specs).collect()}
    assert got == {("Source a", 1, "✅"), ("Source b", 0, "")}


def test_changes(spark):
    base = dict(srcid="s", sources="S", rank=0)
    old = R.merge_register(register(spark, [dict(base, name="same", pos=0), dict(base, name="gone", pos=1), dict(base, name="moved", phone="1", pos=2)]))
    new = R.merge_register(register(spark, [dict(base, name="same", pos=5), dict(base, name="fresh", pos=1), dict(base, name="moved", phone="2", pos=2)]))
    assert {tuple(r) for r in R.register_changes(old, new).collect()} == {("gone||", "removed"), ("fresh||", "added"), ("moved||", "changed")}


def test_unknown_format_is_refused():
    with pytest.raises(ValueError, match="unknown format"):
        spec("s", "/x", format="pdf")


def test_known_registers_are_complete():
    specs = known_registers("/data")
    assert [s.id for s in specs] == ["minato", "kobe", "hyogo", "bodik_maebashi", "fas_maebashi", "fas_kobe", "fas_hyogo", "fas_hakodate"]
    assert {i for _, ids, _ in KNOWN_AREAS for i in ids} == {s.id for s in specs}
    assert all(set(s.colmap) <= set(vocab.REGISTER_COLUMNS) for s in specs)


def test_workbook_cells():
    import io
    import zipfile

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = (f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row>'
             '<row r="3"><c r="A3" s="1"><v>45370</v></c><c r="B3"><v>1.50</v></c><c r="C3" t="b"><v>1</v></c>'
             '<c r="D3" t="str"><v>f(x)</v></c><c r="E3" t="e"><v>#N/A</v></c><c r="F3"><v>2.0</v></c></row></sheetData></worksheet>')
    out = io.BytesIO(workbook([["x"]]))
    with zipfile.ZipFile(out) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = sheet.encode()
    parts["xl/sharedStrings.xml"] = f'<sst {main}><si><r><t>名</t></r><r><t>称</t></r><rPh><t>メイ</t></rPh></si></sst>'.encode()
    parts["xl/styles.xml"] = f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'.encode()
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, b in parts.items():
            z.writestr(n, b)
    assert list(sheet_rows(out.getvalue(), 0)) == [
        ["名称", "", "5"], [], ["2024-03-19 00:00:00", "1.5", "True", "f(x)", "", "2"]]
    with pytest.raises(ValueError, match="no worksheet"):
        list(sheet_rows(out.getvalue(), "other"))


def test_entries_may_share_a_file_and_none_may_lack_one(spark, tmp_path):
    path = tmp_path / "two.csv"
    path.write_text("名,地\nx,1\ny,2\n", encoding="utf-8")
    entries = [spec("one", path, colmap={"name": "名"}), spec("two", path, colmap={"name": "地"})]
    assert sorted((r.source_id, r.row_pos) for r in scan_registers(spark, entries).collect()) == [("one", 0), ("one", 1), ("two", 0), ("two", 1)]
    with pytest.raises(Exception, match="(?i)path|no file"):
        scan_registers(spark, [*entries, spec("gone", tmp_path / "gone.csv")])


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "cp932", "euc_jp"])
def test_encodings_are_found_out(encoding):
    text = "施設名称,住所\n髙橋商店,東京都港区\nカフェ,ひらがな\n".replace("髙", "高")
    assert decode_text(text.encode(encoding), None) == text


def test_half_width_kana_stay_cp932():
    text = "ｶﾌｪ ﾄｳｷｮｳ 食堂\n"
    assert decode_text(text.encode("cp932"), None) == text
    with pytest.raises(ValueError, match="no known encoding"):
        decode_text(b"\x81\x20\x81\x20", None)


def test_path_key_ignores_scheme_and_host(spark):
    from placemill.sources.registry import path_key

    paths = ["/data/a.csv", "file:/data/a.csv", "file:///data/a.csv", "hdfs://host:8020/data/a.csv", "hdfs:///data/a.csv"]
    keys = spark.createDataFrame([(p,) for p in paths], "p string").select(path_key(F.col("p")).alias("k")).distinct().collect()
    assert [r.k for r in keys] == ["/data/a.csv"]


def test_workbook_errors_hints_and_epoch():
    import io
    import zipfile

    from placemill.sources.xlsx import sheet_rows

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def book(properties):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}">{properties}<sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
            z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="e"><v>#REF!</v></c>'
                       '<c r="B1" t="inlineStr"><is><t>東京</t><rPh sb="0" eb="2"><t>トウキョウ</t></rPh></is></c><c r="C1" s="1"><v>1</v></c></row></sheetData></worksheet>')
        return out.getvalue()

    assert list(sheet_rows(book(""), 0)) == [["", "東京", "1899-12-31 00:00:00"]]
    assert list(sheet_rows(book('<workbookPr date1904="1"/>'), 0)) == [["", "東京", "1904-01-02 00:00:00"]]


def test_records_and_fields_equal_a_csv_parser(spark):
    import csv
    import io
    import random

    from placemill.sources.registers import _records, fields_of

    rng = random.Random(9)
    pieces = ["", "a", "b c", "日本", '5" pipe', "x,y", 'say "hi"', "two\nlines", "cr\r\nlf", " ", '""', "'"]
    for end in ("\r\n", "\n"):
        rows = [[rng.choice(pieces) for _ in range(rng.randint(1, 6))] for _ in range(400)]
        rows = [r for r in rows if any(c.strip() for c in r)]
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator=end).writerows(rows)
        records = list(_records(text.getvalue() + end * 2))
        assert len(records) == len(rows)
        got = spark.createDataFrame(list(enumerate(records)), "i int, r string").select("i", fields_of(F.col("r")).alias("f")).orderBy("i").collect()
        assert [r.f for r in got] == rows
    assert list(_records('a"b,c\nd')) == ['a"b,c', "d"]      # a quote inside a plain field is a character
    assert list(_records('"open,\nnext')) and list(_records("")) == []


def test_short_long_and_repeated_columns(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_bytes("名称, 名称 ,TEL,\r\nx\r\n\r\ny,2,3,4,5,6\r\n \r\n\"z\",\"\",\"q\"".encode())
    got = [(r.row_pos, r.record) for r in scan_registers(spark, [spec("odd", path)]).orderBy("row_pos").collect()]
    assert got == [(0, {"名称": "x", "TEL": "", "": ""}), (1, {"名称": "y", "TEL": "3", "": "4"}), (2, {"名称": "z", "TEL": "q", "": ""})]
    empty = tmp_path / "empty.csv"
    empty.write_bytes(b"\r\n\r\nname\r\n")
    assert scan_registers(spark, [spec("empty", empty)]).count() == 0


def test_registry_as_a_table(spark, files, tmp_path):
    """The same records, rows and missing columns as by the list, with nothing of the registry broadcast."""
    from placemill.sources.registry import registry_frame
    from tests.conftest import plan_of

    table = registry_frame(spark, files)
    table.write.parquet(str(tmp_path / "registry"))
    table, folder = spark.read.parquet(str(tmp_path / "registry")), files[0].path.rsplit("/", 1)[0]
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    records = scan_registers(spark, table, folder)
    assert same(records, scan_registers(spark, files))
    assert same(R.normalize_records(records, table), R.normalize_records(records, files))
    assert same(R.missing_columns(records, table), R.missing_columns(records, files))
    assert "Broadcast" not in plan_of(R.normalize_records(records, table)) and "Broadcast" not in plan_of(R.missing_columns(records, table))


def test_landed_files_are_the_given_bytes(spark, tmp_path):
    from placemill_checks import frames

    rows = {"a-0": b"\xef\xbb\xbfx,y\r\n1,2", "a-1": "名,住".encode("cp932"), "b-0": frames.workbook([["x"], ["1"]])}
    for source, content in rows.items():
        end = "\0\0" if source == "b-0" else "\r\n"
        frame = spark.createDataFrame([(source, bytearray(content[:-2] if source == "b-0" else content))], "source_id string, content binary")
        frames._land(frame, str(tmp_path / source), end)
        (found,) = (tmp_path / source).glob(f"source_id={source}/*.txt")
        assert found.read_bytes() == content + (b"" if source == "b-0" else b"\r\n")
