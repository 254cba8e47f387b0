import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwise.catalog import uploads
from tillwise.operators import ingest as ingest_module
from tillwise.operators import mapping as mapping_module
from tillwise.operators.economics import view_kpis
from tillwise.operators.ingest import Ingest, ingest
from tillwise.operators.mapping import clean_header, infer_mapping, mapping_warnings, require_mapping
from tillwise.plans.upload import accept, load_upload
from tillwise.sources.sinks import write_issues
from tillwise.sources.tables import read_upload

COLUMNS = ["Invoice Date", "Invoice No", "SKU Name", "Qty", "Sales Value", "COGS", "Region", "Discount %"]
GOOD = ["2026-01-05", "INV-1", "Alpha", "2", "1000", "600", "West", "10"]


def upload(spark, *rows, columns=COLUMNS):
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _tillwise_row bigint"
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], schema).repartition(3)


def checked(spark, *rows, columns=COLUMNS) -> Ingest:
    return ingest(upload(spark, *rows, columns=columns), infer_mapping(columns))


def changed(**values):
    names = {"date": 0, "order": 1, "product": 2, "quantity": 3, "revenue": 4, "cost": 5, "region": 6, "discount": 7}
    row = list(GOOD)
    for name, value in values.items():
        row[names[name]] = value
    return row


def issues(result):
    return sorted((r.row, r.field, r.value, r.issue) for r in result.issues.collect())


def test_headers():
    assert clean_header("  Customer_Segment-- (B2B)! ") == "customer segment b2b"
    assert clean_header("Discount  %") == "discount %"


def test_mapping_of_common_headings():
    found = infer_mapping(COLUMNS)
    assert (found["order_date"], found["product"], found["net_revenue"], found["cost"]) == (
        "Invoice Date",
        "SKU Name",
        "Sales Value",
        "COGS",
    )
    assert (found["quantity"], found["discount_rate"], found["channel"]) == ("Qty", "Discount %", "")


def test_mapping_prefers_exact_names_and_reuses_columns():
    found = infer_mapping(["Gross Amount", "Amount", "Product Group"])
    assert found["net_revenue"] == "Amount"
    assert found["category"] == found["product"] == "Product Group"
    assert infer_mapping(["###"])["region"] == "###"


def test_required_mapping():
    for missing in mapping_module.REQUIRED_FIELDS:
        with pytest.raises(ValueError, match="must be mapped"):
            require_mapping({**infer_mapping(COLUMNS), missing: ""})
    with pytest.raises(ValueError, match="Cost / COGS or Gross profit"):
        require_mapping({**infer_mapping(COLUMNS), "cost": "", "gross_profit": ""})


def test_warnings():
    found = mapping_warnings({})
    assert len(found) == 5 and found[0].startswith("Order ID was not mapped")
    assert found[1] == "Region was not mapped; that drilldown will use “Unspecified”."


def test_valid_and_rejected_rows(spark):
    result = checked(spark, GOOD, ["bad-date", "INV-2", "Beta", "1", "500", "300", "South", "0"])
    report = result.quality.first()
    assert (report.total_rows, report.valid_rows, report.rejected_rows) == (2, 1, 1)
    fact = result.facts.first()
    assert (fact.gross_profit, fact.net_revenue, fact.order_date) == (400, 1000, dt.date(2026, 1, 5))
    assert fact.gross_revenue == pytest.approx(1000 / 0.9)
    assert fact.discount_rate == pytest.approx(0.1)
    assert (fact.transaction_id, fact.order_id, fact.month, fact.category) == ("upload-0000001", "INV-1", "2026-01", "Unspecified")
    assert issues(result) == [(3, "order_date", "bad-date", "Unparseable or missing date")]


def test_all_collected_issues_of_a_row_are_reported(spark):
    result = checked(spark, changed(date="", revenue="(5)", quantity="0", cost="n/a"))
    assert issues(result) == [
        (2, "cost/profit", "", "Cost or gross profit is required"),
        (2, "net_revenue", "(5)", "Revenue must be a non-negative number"),
        (2, "order_date", "", "Unparseable or missing date"),
        (2, "quantity", "0", "Quantity must be positive"),
    ]


def test_later_checks_report_one_issue(spark):
    result = checked(
        spark,
        changed(cost="(5)", discount="-1"),
        changed(order="b", discount="100"),
        changed(order="c", discount="1%"),
        changed(order="d", discount="101"),
        changed(order="e", discount="oops"),
        changed(order="f", discount="0.25"),
    )
    limit = "Discount rate must be between 0% and <100%"
    assert issues(result) == [
        (2, "cost", "-5", "Cost cannot be negative"),
        (3, "discount_rate", "100", limit),
        (4, "discount_rate", "1%", limit),
        (5, "discount_rate", "101", limit),
    ]
    rates = {r.order_id: r.discount_rate for r in result.facts.collect()}
    assert rates == {"e": 0, "f": pytest.approx(0.25)}


def test_copies_are_rejected_before_other_checks(spark):
    bad = changed(date="bad")
    result = checked(spark, GOOD, bad, GOOD, bad, GOOD)
    assert sorted((r.row, r.issue) for r in result.duplicates.collect()) == [(4, "Exact duplicate row"), (5, "Exact duplicate row"), (6, "Exact duplicate row")]
    report = result.quality.first()
    assert (report.valid_rows, report.duplicate_rows, report.issue_count) == (1, 3, 4)
    # 80% rejected, two unmapped dimensions beside an unmapped segment: 100 - 80 - 4.5, halves up.
    assert report.score == 16
    assert len(report.warnings) == 3 and report.checks[0] == "schema_mapping"


def test_defaults_and_profit_only(spark):
    columns = ["Date", "Item", "Sales", "Profit"]
    rows = upload(spark, ["2026-01-05", " ", "$1,000", "250"], columns=columns)
    found = {f: "" for f in mapping_module.FIELDS} | {"order_date": "Date", "product": "Item", "net_revenue": "Sales", "gross_profit": "Profit"}
    fact = ingest(rows, found).facts.first()
    assert (fact["product"], fact.order_id, fact.quantity, fact.cost) == ("Unspecified product", "ROW-0000001", 1, 750)
    assert (fact.gross_revenue, fact.discount_amount, fact.discount_rate) == (1000, 0, 0)


def test_given_discount_amounts_win_and_are_clamped(spark):
    columns = [*COLUMNS, "Discount Amount"]
    result = checked(spark, [*GOOD, "250"], [*changed(order="b"), "(40)"], columns=columns)
    got = {r.order_id: (r.discount_amount, r.gross_revenue, r.discount_rate) for r in result.facts.collect()}
    assert got == {"INV-1": (250, 1250, 0.2), "b": (0, 1000, 0)}


def test_no_valid_rows(spark):
    with pytest.raises(ValueError, match="No valid rows remain"):
        accept(upload(spark, changed(date="x")))


CSV = """Invoice Date, Invoice No ,SKU Name,Qty,Sales Value,COGS,Region,Discount %
2026-01-05,INV-1,"Alpha, ""large""
size",2,"1,000",600,West,10

,,,,,,,
bad,INV-2,Beta,1,500
2026-01-07,INV-3,Gamma,1,$500,300,South,0
2026-01-07,INV-3,Gamma,1,$500,300,South,0
"""


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_reading(spark, csv):
    rows = sorted(read_upload(spark, csv).collect(), key=lambda r: r._tillwise_row)
    assert [r._tillwise_row for r in rows] == [0, 1, 2, 3]
    assert rows[0]["SKU Name"] == 'Alpha, "large"\nsize' and rows[0]["Invoice No"] == "INV-1"
    assert rows[1]["Region"] == ""


def test_rows_of_several_files_are_numbered_through(spark, tmp_path):
    for i in range(5):
        lines = "\n".join(f"2026-01-0{i + 1},P{i}-{j},{j + 1},1" for j in range(40))
        (tmp_path / f"part-{i}.csv").write_text("Date,Item,Sales,COGS\n" + lines + "\n")
    rows = sorted(read_upload(spark, str(tmp_path)).collect(), key=lambda r: r._tillwise_row)
    assert [r._tillwise_row for r in rows] == list(range(200))
    assert [r.Item for r in rows] == [f"P{i}-{j}" for i in range(5) for j in range(40)]


def test_unreadable_uploads(spark, tmp_path):
    (tmp_path / "none.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="readable table"):
        read_upload(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="Unsupported"):
        read_upload(spark, "book.xlsx")


def test_upload_end_to_end(spark, csv, tmp_path):
    out = str(tmp_path / "out")
    result = load_upload(spark, csv, out)
    quality = spark.read.parquet(f"{out}/quality").first()
    assert (quality.total_rows, quality.valid_rows, quality.duplicate_rows) == (4, 2, 1)
    summary = spark.read.parquet(f"{out}/summary").first()
    assert (summary.net_revenue, summary.orders) == (1500, 2)
    rejected = spark.read.option("header", True).option("escape", '"').csv(f"{out}/issues")
    assert rejected.columns == ["row", "field", "value", "issue"]
    assert {(r.row, r.field) for r in rejected.collect()} == {("3", "order_date"), ("3", "cost/profit"), ("5", "row")}
    assert spark.read.parquet(f"{out}/metadata").first().row_count == 2
    assert view_kpis(result.facts).first().units == 3
    write_issues(result.preview, f"{out}/preview")


def test_no_header_can_hide_rows_or_columns(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("row_index,_file,_place, Item ,Item,_date,item\n1,a,x,old,A,q,1\n2,a,x,old,A,q,1\n2,b,x,old,A,q,1\n\t,,,,,,\n")
    rows = read_upload(spark, str(path))
    assert rows.count() == 3
    first = rows.orderBy("_tillwise_row").first()
    assert (first["row_index"], first["_file"], first["_place"], first["Item"], first["_date"], first["item (2)"]) == ("1", "a", "x", "A", "q", "1")
    (tmp_path / "reserved.csv").write_text("_tillwise_row,b\n1,2\n")
    with pytest.raises(ValueError, match="reserved"):
        read_upload(spark, str(tmp_path / "reserved.csv"))


def test_rows_that_differ_in_a_clashing_column_are_kept(spark, tmp_path):
    path = tmp_path / "clash.csv"
    path.write_text("Date,Item,Sales,COGS,row_index,_date\n2026-01-05,A,10,5,1,x\n2026-01-05,A,10,5,2,x\n2026-01-05,A,10,5,2,x\n")
    result = load_upload(spark, str(path), str(tmp_path / "out"))
    assert result.facts.count() == 2 and result.duplicates.count() == 1


def test_upload_queries_size_their_shuffles_by_the_lines(spark, tmp_path, monkeypatch):
    """The upload is the lines: left at Spark's fixed partitions, its sort and grouping spill as the lines grow."""
    from tillwise.catalog import queries
    from tillwise.sources.star import TABLE_SCHEMAS

    folder = str(tmp_path / "tables")
    spark.createDataFrame([], TABLE_SCHEMAS["lineitem"]).write.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(queries, "sales_upload", lambda spark, folder: upload(spark, GOOD))
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.unset(k)
        assert queries.QUERIES["ingest_quality"](spark, folder).first().total_rows == 1
        assert all(int(spark.conf.get(k).rstrip("b")) <= 4 * 1024 * 1024 for k in keys)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_parsing_stays_in_generated_code(spark):
    """A function over array elements took the whole projection with the parsing in it out of generated code."""
    plan = checked(spark, GOOD).checked  # written; the plan of the check itself is looked at
    rows = ingest_module.check_rows(upload(spark, GOOD), infer_mapping(COLUMNS))
    assert plan.count() == 1
    assert "lambdafunction" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_packed_texts_are_told_apart(spark):
    end, mark = ingest_module.CELL_END, ingest_module.MARK
    odd = ["", None, "a", end, mark, f"{mark}1", f"{mark}2", f"{mark}0", f"a{end}b", f"{mark}{end}", f"{end}{mark}2"]
    pairs = [(x, y) for x in odd for y in odd]
    rows = spark.createDataFrame([(*p, 1.5, i) for i, p in enumerate([*pairs, *pairs])], "x string, `y z` string, v double, _tillwise_row bigint")
    found = sorted(map(tuple, ingest_module._grouped(rows.repartition(3)).collect()), key=lambda r: r[-1])
    assert found == [(*p, 1.5, i) for i, p in enumerate(pairs)]


def test_many_copies_are_grouped_without_a_shuffle_of_all_digests(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("a filter was made of more digests than it holds")

    monkeypatch.setattr(ingest_module, "key_filter", refused)
    monkeypatch.setattr(ingest_module, "CAPACITY", 0)
    rows = upload(spark, GOOD, changed(order="b"), GOOD)
    found = ingest_module.first_occurrences(rows, lambda columns: F.lit(0).cast("bigint"))
    assert sorted(r._tillwise_row for r in found.collect()) == [0, 1]


ODD_LINES = [(3, 1, "A"), (1, 2, "N"), (None, 1, "A"), (2, 1, "A"), (2, None, "R"), (9, 7, "A"), (None, None, "N"), (1, 1, "A"), (40, 2, "R"), (-5, 2, "A")]


@pytest.fixture()
def odd_tables(spark, tmp_path):
    """Lines with null and repeated order keys, an order and a part that come twice, and lines without either."""
    from tillwise.sources.star import TABLE_SCHEMAS

    day = dt.datetime(1996, 3, 1)
    lines = [(o, p, 1, n, 5.0, 100.0 + n, 0.05, 0.02, flag, "O", day) for n, (o, p, flag) in enumerate(ODD_LINES)]
    orders = [(k, 1, "O", day, f"{k}-{i}") for k in (1, 2, 3, 40, -5) for i in range(2 if k == 2 else 1)]
    parts = [(1, "red", "PROMO", 10.0), (2, "blue", "SMALL", 20.0), (2, "blue", "SMALL", 21.0)]
    folder = str(tmp_path / "odd")
    for name, rows in (("lineitem", lines), ("orders", orders), ("part", parts)):
        spark.createDataFrame(rows, TABLE_SCHEMAS[name]).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_upload_is_numbered_by_slices_of_the_order_key(spark, odd_tables, monkeypatch, broadcast):
    plans, kept = [], uploads.stored

    def watched(df, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, **options)

    monkeypatch.setattr(uploads, "stored", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rows = {r["_tillwise_row"]: r for r in uploads.sales_upload(spark, odd_tables).collect()}
        plain = uploads.sales_lines(spark, odd_tables).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(rows) == list(range(len(rows))) and len(rows) == plain
    # Every line as often as its order and part are stored, in order, null first; then those of flag A again.
    times = [(o, n, f, (2 if o == 2 else 1) * (2 if p == 2 else 1)) for n, (o, p, f) in enumerate(ODD_LINES)]
    ordered = [x for x in sorted(times, key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for _ in range(x[3])]
    wanted = [x for x in ordered] + [x for x in ordered if x[2] == "A"]
    assert [rows[i]["Invoice No"] for i in range(len(rows))] == ["" if x[0] is None else f"INV-{x[0]}" for x in wanted]
    assert [rows[i]["Sales Value"] for i in range(len(rows))] == [f"${(100 + x[1]) * 0.95:.2f}" for x in wanted]
    assert "rangepartitioning" not in plans[0]
    # One exchange by slice serves the join with the orders and the numbering.
    if broadcast == "-1":
        assert plans[0].count("hashpartitioning(_tillwise_slice") == 2


def test_slices_rise_with_the_key(spark):
    keys = spark.createDataFrame([(k,) for k in [5, 5, 5, 5, 900, -3, None, 2**60, 2**60 + 1, 7, 8]], "k bigint")
    for slices in (1, 4, 50):
        found = uploads.key_slices(keys, "k", slices)(keys).collect()
        ordered = sorted((r for r in found if r.k is not None), key=lambda r: r.k)
        numbers = [r["_tillwise_slice"] for r in ordered]
        assert numbers == sorted(numbers) and min(numbers) >= 0
        assert [r["_tillwise_slice"] for r in found if r.k is None] == [-1]
    assert uploads.key_slices(keys.limit(0), "k", 4)(keys).count() == 11
