"""From files to files, on rows with known results."""

import json

import pytest
from pyspark.sql import functions as F

from ledgertag import classify, run_job
from ledgertag.functions.period import Period
from ledgertag.operators.validate import applied_rules, validate_rules
from ledgertag.plans.job import arguments
from ledgertag.schemas import OUT_SCHEMA, RULE_SCHEMA
from ledgertag.sources.readers import broken_lines, read_classifier, read_rules, read_transactions, sound_rows
from ledgertag.sources.sinks import lookup, materialise, write_result
from tests import fixed_rows as rows
from workload.strategies import STRATEGIES, classify_by

# The period that holds every known row, and a day after the last one.
WHOLE = ("1800-03-01", "9999-03-01")
AFTER = "2021-04-01"


def write_lines(path, records, gap=None):
    lines = [json.dumps(r, ensure_ascii=False) for r in records]
    if gap is not None:
        lines.insert(gap, "")
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    amounts = (r | {"amount": 0} for r in rows.transaction_records())
    tx = write_lines(folder / "transactions.json", amounts, gap=3)
    with open(tx, encoding="utf-8") as f:
        text = f.read()
    with open(tx, "w", encoding="utf-8") as f:
        f.write(text.replace('"amount": 0', '"amount": 0E-10') + "{broken\n")
    return {
        "transactions": tx,
        "rules": write_lines(folder / "rules.json", rows.rule_records()),
        "classifier": write_lines(
            folder / "classifier.json", rows.classifier_records()
        ),
    }


@pytest.fixture(scope="module")
def inputs(spark, paths):
    return (
        read_transactions(spark, paths["transactions"]),
        read_rules(spark, paths["rules"]),
        read_classifier(spark, paths["classifier"]),
    )


@pytest.fixture(scope="module", params=["classify", *STRATEGIES])
def result(inputs, request):
    if request.param == "classify":
        df = classify(*inputs, *WHOLE)
    else:
        df = classify_by(request.param, *inputs, *WHOLE).select(OUT_SCHEMA.names)
    materialise(df)
    return df


def test_files_are_read_with_declared_types(inputs):
    tx, rules, classifier = inputs
    assert tx.filter("id_pk IS NOT NULL").count() == 14
    assert tx.filter("id_pk IS NULL").count() <= 1
    assert tx.filter("amount = 0").count() == 14
    assert [r.input_dt.isoformat() for r in tx.filter("id_pk IS NOT NULL").select("input_dt").distinct().collect()] == ["2021-03-01"]
    assert rules.count() == 10
    assert rules.filter("id_pk = 14 AND updated_ts IS NULL").count() == 1
    assert dict(classifier.dtypes)["actual_from"] == "date"


def test_rules_in_use(inputs):
    _, rules, classifier = inputs
    valid = validate_rules(rules, classifier, Period.parse(*WHOLE))
    assert [r.rid for r in applied_rules(valid).collect()] == [1, 2, 3, 10, 14]


@pytest.mark.parametrize("suffix", sorted({t[0] for t in rows.TRANSACTIONS}))
def test_tags(result, suffix):
    found = lookup(result, rows.ID_PREFIX + suffix).collect()
    tags = [(r.dt_tax_item_auto, r.kt_tax_item_auto) for r in found]
    expected = rows.EXPECTED.get(suffix)
    assert tags == ([expected] if expected else [])


def test_result_schema_and_one_run_time(result):
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in _in_result_order()
    ]
    assert result.select("created_ts").distinct().count() == 1


def _in_result_order():
    return [OUT_SCHEMA[n] for n in OUT_SCHEMA.names]


def test_period_outside_the_data(inputs):
    assert classify(*inputs, AFTER, AFTER).count() == 0


def test_no_rules_give_an_empty_typed_result(spark, inputs):
    tx, _, classifier = inputs
    none = spark.createDataFrame([], RULE_SCHEMA)
    df = classify(tx, none, classifier, *WHOLE)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in OUT_SCHEMA
    ]
    assert df.count() == 0


def test_no_valid_rule_gives_an_empty_result(spark, inputs):
    tx, rules, classifier = inputs
    lone = rules.filter("id_pk = 6")
    assert classify(tx, lone, classifier, *WHOLE).count() == 0


@pytest.mark.parametrize(
    "start, end",
    [
        (None, "2021-01-01"),
        ("2021-01-01", ""),
        ("01.02.2021", "2021-01-01"),
        ("20210101", "2021-01-01"),
        ("2021-02-30", "2021-03-01"),
    ],
)
def test_period_must_be_given_as_iso_dates(inputs, start, end):
    with pytest.raises(ValueError):
        classify(*inputs, start, end)


def test_job_writes_one_folder_per_load_date(spark, paths, tmp_path):
    out = str(tmp_path / "out")
    run_job(spark, paths, *WHOLE, out=out)
    back = spark.read.parquet(out)
    assert back.filter("input_dt = DATE'2021-03-01'").count() == len(rows.EXPECTED)
    assert [p.name for p in (tmp_path / "out").glob("input_dt=*")] == [
        "input_dt=2021-03-01"
    ]
    with pytest.raises(Exception, match="(?i)exist"):
        run_job(spark, paths, *WHOLE, out=out)
    run_job(spark, paths, *WHOLE, out=out, mode="overwrite")
    assert spark.read.parquet(out).count() == len(rows.EXPECTED)


def test_job_reports_the_rules_it_applies(spark, paths, tmp_path, caplog):
    caplog.set_level("INFO", logger="ledgertag.plans.job")
    run_job(spark, paths, *WHOLE, out=str(tmp_path / "some"))
    assert "applied rules: 1, 2, 3, 10, 14" in caplog.text
    run_job(spark, paths | {"rules": write_lines(tmp_path / "none.json", [])}, *WHOLE, out=str(tmp_path / "none"))
    assert any(r.levelname == "WARNING" and "no rule applies" in r.message for r in caplog.records)


def test_broken_lines_are_counted_and_kept(spark, paths, tmp_path, caplog):
    """The transactions end in a broken line; rules and classifier get one each."""
    kept = tmp_path / "kept"
    bad = dict(paths)
    for name in ("rules", "classifier"):
        bad[name] = str(tmp_path / f"{name}.json")
        with open(paths[name], encoding="utf-8") as f, open(bad[name], "w", encoding="utf-8") as g:
            g.write(f.read() + '{"id_pk": 99, "tax_item_ofr": 1\n')
        with pytest.raises(ValueError, match=f"1 lines of the {name}"):
            run_job(spark, paths | {name: bad[name]}, *WHOLE, out=str(tmp_path / "refused"))
    assert not (tmp_path / "refused").exists()
    caplog.set_level("INFO", logger="ledgertag.plans.job")
    for _ in range(2):  # a second run replaces what the first one kept
        counts = run_job(spark, bad, *WHOLE, out=str(tmp_path / "out"), mode="refresh", quarantine=str(kept))
    assert counts["broken"] == 1 and counts["lines"] >= 15 and counts["rows"] == len(rows.EXPECTED)
    assert counts["matches"] >= counts["rows"] and counts["rules"] >= 1
    tagged = [sum(t[n] is not None for t in rows.EXPECTED.values()) for n in (0, 1)]
    assert [counts["dt_tagged"], counts["kt_tagged"]] == tagged
    assert "1 lines of the transactions can't be read" in caplog.text and "counts: lines" in caplog.text
    for name in ("transactions", "rules", "classifier"):
        (line,) = spark.read.parquet(f"{kept}/{name}").select("file", "line").collect()
        assert line.file.endswith(bad[name].split("/")[-1]) and line.line.startswith("{")
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows.EXPECTED)


def test_a_transaction_that_can_be_read_in_part_takes_part(spark, tmp_path):
    path = tmp_path / "part.json"
    path.write_text('{"id_pk": "a", "operation_date": "2021-01-01T00:00:00Z", "input_dt": "x"}\n{"id_pk": \n{"id_pk": "b"}\n')
    read = read_transactions(spark, str(path), broken=True)
    assert sorted(r.id_pk for r in sound_rows(read, key="id_pk").collect()) == ["a", "b"]
    assert [r.id_pk for r in sound_rows(read).collect()] == ["b"]
    assert broken_lines(read).count() == 2 and broken_lines(read, ["id_pk"]).count() == 1
    assert sorted(r.id_pk for r in sound_rows(read, ["id_pk"]).select("id_pk").collect()) == ["a", "b"]
    assert "_broken_line" not in read_transactions(spark, str(path)).columns


def test_files_of_other_formats_are_read_as_before(spark, inputs, tmp_path):
    names = ("transactions", "rules", "classifier")
    files = {n: str(tmp_path / n) for n in names}
    for name, df in zip(names, inputs, strict=True):
        df.filter("id_pk IS NOT NULL" if name != "classifier" else "true").write.parquet(files[name])
    counts = run_job(spark, files, *WHOLE, out=str(tmp_path / "out"), source="parquet")
    assert counts["rows"] == len(rows.EXPECTED) and "lines" not in counts


def result_frame(spark, days, tag="1"):
    return spark.range(40_000).select(
        F.format_string("id-%08d", F.xxhash64("id") % 90_000_000).alias("id_pk"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("input_dt"),
        F.lit(tag).alias("dt_tax_item_auto"),
    )


def test_a_run_for_dates_that_exist_replaces_only_those(spark, tmp_path):
    out = tmp_path / "out"
    write_result(result_frame(spark, 3), str(out))

    def files(day):
        return {p.name: (p.stat().st_mtime_ns, p.read_bytes()) for p in (out / f"input_dt=2021-01-0{day}").glob("*.parquet")}

    def contents(day):
        return sorted(map(tuple, spark.read.parquet(str(out)).filter(f"input_dt = DATE'2021-01-0{day}'").collect()))

    before, first = {d: files(d) for d in (1, 2, 3)}, contents(2)
    one_day = result_frame(spark, 3).filter("input_dt = DATE'2021-01-02'")
    write_result(one_day, str(out), "refresh")
    assert files(1) == before[1] and files(3) == before[3]
    assert {len(b) for _, b in files(2).values()} == {len(b) for _, b in before[2].values()}  # the same rows once more
    assert contents(2) == first
    write_result(one_day.withColumn("dt_tax_item_auto", F.lit("2")).limit(5), str(out), "refresh")
    assert [r[1] for r in contents(2)] == ["2"] * 5 and files(1) == before[1]
    write_result(one_day, str(out), "overwrite")
    assert [p.name for p in out.glob("input_dt=*")] == ["input_dt=2021-01-02"]


def rows_read(df):
    """Rows that the scan passed on, after row groups are left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    """Files are sorted by id, and Bloom filters refuse ids that lie in a group's range."""
    out = str(tmp_path / "out")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "65536")
    conf.set("parquet.page.row.count.limit", "1000")
    try:
        write_result(result_frame(spark, 2), out)
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.row.count.limit")
    written = spark.read.parquet(out)
    files = written.inputFiles()
    groups = sum(spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(f), conf)
    ).getRowGroups().size() for f in files)
    assert groups >= 6
    held = written.select("id_pk").orderBy("id_pk").limit(20_000).collect()[-1].id_pk
    assert lookup(written, held).count() >= 1
    assert rows_read(lookup(written, held)) <= 40_000 / groups * 3
    absent = [f"{held}x{n}" for n in range(20)]
    read = [rows_read(lookup(written, a)) for a in absent]
    assert sum(n == 0 for n in read) >= 18


def test_job_refuses_rules_that_cannot_be_applied(spark, paths, tmp_path):
    records = list(rows.rule_records())
    broken = records[0] | {"id_pk": 77, "payment_purpose_pattern_list": "a\\b"}
    bad = paths | {"rules": write_lines(tmp_path / "bad.json", [*records, broken])}
    with pytest.raises(ValueError, match="77 .*stray escape in purposes"):
        run_job(spark, bad, *WHOLE, out=str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()


def test_job_cuts_moments_to_days_in_its_own_zone(spark, paths, tmp_path):
    """The rows are of 17:00 UTC on the only day of most rules, which is the next day in Tokyo."""
    own = spark.conf.get("spark.sql.session.timeZone")
    for zone, found in (("UTC", 1), ("Asia/Tokyo", 0)):
        out = tmp_path / zone.replace("/", "-")
        counts = run_job(spark, paths, *WHOLE, out=str(out), zone=zone)
        assert len(list(out.glob("input_dt=*"))) == found
        assert counts["rows"] == (len(rows.EXPECTED) if found else 0)
    assert spark.conf.get("spark.sql.session.timeZone") == own


def test_sink_splits_a_load_date_that_holds_most_rows(spark, tmp_path):
    out = tmp_path / "skewed"
    df = spark.range(300_000).select(
        F.col("id").cast("string").alias("id_pk"),
        F.when(F.col("id") % 3 == 0, F.lit("2021-01-02"))
        .otherwise(F.lit("2021-01-01"))
        .cast("date")
        .alias("input_dt"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "200KB")
    try:
        write_result(df, str(out))
    finally:
        spark.conf.set(size, before)
    assert len(list((out / "input_dt=2021-01-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(out)).count() == 300_000


def test_arguments_of_the_job():
    files = ["--transactions", "t", "--rules", "r", "--classifier", "c", "--out", "o"]
    for s, e in (("-s", "-e"), ("--start", "--end"), ("--start_date", "--end_date")):
        args = arguments([s, "2021-01-01", e, "2021-01-31", "--quiet", *files])
        assert (args.start_date, args.end_date, args.quiet) == (
            "2021-01-01",
            "2021-01-31",
            True,
        )
    assert arguments(files).start_date is None
