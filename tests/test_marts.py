import datetime as dt
import io
import json
import time
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakemart import jobs, spec
from lakemart.operators.quality import GateError
from lakemart.plans import serving, snapshots
from lakemart.plans.ads import AdsMart, insight_schema
from lakemart.plans.sales import SalesMart, flatten_sales
from lakemart.plans.snapshots import ProjectionsMart, SheetSalesMart, SubscriptionsMart
from lakemart.plans.upkeep import all_tables, maintain
from lakemart.sources.landing import read_partition

RUN = dt.date(2024, 2, 1)


def next_run(n):
    return RUN + dt.timedelta(days=n)


def land(root, run, name, records):
    path = root / f"ingestion_date={run}" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records, ensure_ascii=False), encoding="utf-8")


# ---- ads ---------------------------------------------------------------------------------


def insight(day, ident, spend, name="n", **more):
    return {"campaign_id": "c1", "adset_id": "s1", "ad_id": ident, "ad_name": name, "date_start": day, "spend": spend, **more}


def ads_load(spark, tmp_path, mart, run, records, **lookups):
    land(tmp_path / "api", run, "insights.json", records)
    landed = read_partition(spark, str(tmp_path / "api"), run, insight_schema(mart.level), arrays=True)
    mart.load(landed, run, **lookups)


def test_ads_restatement_window_and_dimension(spark, rows, tmp_path):
    mart = AdsMart(spark, str(tmp_path / "lake"), "ad")
    creatives = spark.createDataFrame([("a1", "u", "c", "t")], "ad_id string, " + ", ".join(f"{c} string" for c in spec.VIDEO_COLUMNS))
    actions = [{"action_type": "lead", "value": "3"}, {"action_type": "omni_purchase", "value": "1.5"}]
    ads_load(spark, tmp_path, mart, RUN, [
        insight("2024-01-01", "a1", "1.5", "first", actions=actions, impressions=7, ctr="abc"),
        insight("2024-01-20", "a1", 2, "second"),
        insight("2024-01-20", "a1", 4, "last of the day"),
        insight("2024-01-20", "idle", "0"),
        insight("2024-13-05", "bad day", "1"),
        insight(None, "no day", "1"),
    ], creatives=creatives)
    fact = mart.fact.read()
    assert rows(fact, "data", "ad_id", "spend", "leads", "purchase_value", "impressions", "ctr", "clicks") == [
        (dt.date(2024, 1, 1), "a1", 1.5, 3, 1.5, 7, None, 0), (dt.date(2024, 1, 20), "a1", 4.0, 0, 0.0, 0, 0.0, 0),
    ]
    assert rows(mart.dimension.read()) == [("a1", "last of the day", "u", "c", "t")]
    rejects = spark.read.parquet(f"{mart.rejects_root}/ingestion_date={RUN}")
    assert rows(rejects, "ad_id") == [("bad day",), ("no day",)]

    # A later run restates the window, and a day before it only reaches bronze.
    ads_load(spark, tmp_path, mart, next_run(1), [
        insight("2024-01-01", "a1", "99"), insight("2024-01-15", "a2", "5"), insight("2024-01-20", "a1", "6", "renamed"),
    ])
    assert rows(mart.fact.read(), "data", "ad_id", "spend") == [
        (dt.date(2024, 1, 1), "a1", 1.5), (dt.date(2024, 1, 15), "a2", 5.0), (dt.date(2024, 1, 20), "a1", 6.0),
    ]
    assert rows(mart.bronze.read().where("data = '2024-01-01'"), "spend") == [(99.0,)]
    assert rows(mart.dimension.read(), "ad_id", "ad_name") == [("a1", "renamed"), ("a2", "n")]


def test_ads_runs_without_data_or_ids(spark, rows, tmp_path):
    mart = AdsMart(spark, str(tmp_path / "lake"), "ad")
    ads_load(spark, tmp_path, mart, RUN, [insight("2024-01-01", "a1", "1")])
    before = rows(mart.fact.read())
    # Nothing staged: the run's own partition is missing, and nothing older is loaded again.
    ads_load(spark, tmp_path, mart, next_run(1), [insight("2024-01-02", "a1", "0")])
    assert rows(mart.fact.read()) == before
    with pytest.raises(GateError, match="without ad_id"):
        ads_load(spark, tmp_path, mart, next_run(2), [insight("2024-01-03", None, "1")])
    assert rows(mart.fact.read()) == before


def test_bad_days_share_one_folder(spark, rows, tmp_path):
    mart = AdsMart(spark, str(tmp_path / "lake"), "ad")
    ads_load(spark, tmp_path, mart, RUN, [insight("2024-01-01", "a", "1"), insight(None, "none", "1"), *[insight(f"2024-13-{n}", f"b{n}", "1") for n in range(9)]])
    assert [p.name for p in sorted((tmp_path / "lake").glob(f"raw/ads/ad/ingestion_date={RUN}/event_date=*"))] == [
        "event_date=2024-01-01", "event_date=__HIVE_DEFAULT_PARTITION__"]
    rejects = spark.read.parquet(f"{mart.rejects_root}/ingestion_date={RUN}")
    assert rows(rejects, "ad_id", "date_start") == sorted([("none", None), *[(f"b{n}", f"2024-13-{n}") for n in range(9)]], key=repr)
    assert rows(mart.fact.read(), "ad_id") == [("a",)]


def test_adset_audiences(spark, rows, tmp_path):
    mart = AdsMart(spark, str(tmp_path / "lake"), "adset")
    audiences = spark.createDataFrame(
        [("s1", ([("1", "b"), ("2", None)], None)), ("s9", None)],
        "id string, targeting struct<custom_audiences: array<struct<id: string, name: string>>,"
        " flexible_spec: array<struct<custom_audiences: array<struct<id: string, name: string>>>>>",
    )
    records = [{"adset_id": s, "campaign_id": "c", "adset_name": s, "date_start": "2024-01-01", "clicks": 1} for s in ("s1", "s2")]
    ads_load(spark, tmp_path, mart, RUN, records, audiences=audiences)
    assert rows(mart.dimension.read()) == [("s1", "s1", "b | CA:2"), ("s2", "s2", "")]


def test_daily_ads_loads_equal_one_load(spark, rows, tmp_path):
    records = [
        {"campaign_id": f"c{k}", "campaign_name": f"n{k}", "date_start": f"2024-01-{d:02}", "spend": str(d * 10 + k + 1)}
        for d in range(1, 7) for k in range(3)
    ]
    whole, daily = (AdsMart(spark, str(tmp_path / name), "camp") for name in ("whole", "daily"))
    ads_load(spark, tmp_path / "w", whole, RUN, records)
    for n, last in enumerate((2, 4, 6)):
        window = [r for r in records if int(r["date_start"][-2:]) <= last]
        stale = [{**r, "spend": "1"} if int(r["date_start"][-2:]) == last and last < 6 else r for r in window]
        ads_load(spark, tmp_path / "d", daily, next_run(n), stale)
    columns = whole.level.fact_columns
    assert rows(daily.fact.read(), *columns) == rows(whole.fact.read(), *columns)
    assert rows(daily.dimension.read()) == rows(whole.dimension.read())


# ---- sales -------------------------------------------------------------------------------


def sale(transaction, day, status, buyer="b1", name="Ana", price=10.0, fee=1.0):
    ms = int(dt.datetime.combine(day, dt.time(23, 59, 59), dt.timezone.utc).timestamp() * 1000)
    return {
        "purchase": {"transaction": transaction, "status": status, "order_date": ms, "price": {"value": price, "currency_code": "BRL"},
                     "hotmart_fee": {"total": fee}},
        "product": {"id": 1, "name": "p"}, "buyer": {"ucode": buyer, "name": name},
    }


def sales_load(spark, tmp_path, mart, run, records):
    land(tmp_path / "api", run, "sales.json", records)
    landed = read_partition(spark, str(tmp_path / "api"), run, spec.SALES_RECORD_DDL, arrays=True)
    mart.load(flatten_sales(landed), run)


def test_sales_status_changes_and_redating(spark, rows, tmp_path):
    mart = SalesMart(spark, str(tmp_path / "lake"))
    d = dt.date
    sales_load(spark, tmp_path, mart, RUN, [
        sale("t1", d(2024, 1, 31), "APPROVED"), sale("t1", d(2024, 1, 31), "COMPLETE"),
        sale("t2", d(2023, 3, 1), "APPROVED", buyer=None), sale("t3", d(2024, 1, 2), "APPROVED", price=None, fee=None),
        {"purchase": {"transaction": None, "order_date": 5}}, {"purchase": {"transaction": "no day"}}, {"product": {"id": 5}},
        {"purchase": {"transaction": "", "order_date": 5}}, {"purchase": {"transaction": "day zero", "order_date": 0}},
    ])
    assert rows(mart.fact.read(), "transaction", "data", "status", "valor_liquido") == [
        ("t1", d(2024, 1, 31), "COMPLETE", 9.0), ("t2", d(2023, 3, 1), "APPROVED", 9.0), ("t3", d(2024, 1, 2), "APPROVED", 0.0),
    ]
    sales_load(spark, tmp_path, mart, next_run(1), [
        sale("t3", d(2024, 2, 3), "MOVED", name="Bia"), sale("t2", d(2023, 3, 1), "TOO OLD"), sale("t4", d(2023, 11, 20), "LATE"),
    ])
    # t2 changed before the 90-day window: bronze knows, gold does not.
    assert rows(mart.fact.read(), "transaction", "data", "status") == [
        ("t1", d(2024, 1, 31), "COMPLETE"), ("t2", d(2023, 3, 1), "APPROVED"), ("t3", d(2024, 2, 3), "MOVED"), ("t4", d(2023, 11, 20), "LATE"),
    ]
    assert rows(mart.bronze.read().where("transaction = 't2'"), "status") == [("TOO OLD",)]
    assert rows(mart.dimensions["dim_cliente"].read(), "buyer_ucode", "buyer_name") == [("b1", "Bia")]
    assert rows(mart.dimensions["dim_produto"].read()) == [(1, "p")]
    assert not mart.dimensions["dim_oferta"].exists()
    assert set(spec.SALES_FACT_COLUMNS) | {"valor_liquido"} == set(mart.fact.read().columns)
    assert maintain(mart.tables()) == [table.path for table in mart.tables() if table.exists()]


def test_sales_numbers_land_quoted_or_not(spark, rows, tmp_path):
    mart = SalesMart(spark, str(tmp_path / "lake"))
    record = sale("t1", dt.date(2024, 1, 31), "A", price="10.50", fee=1)
    record["purchase"] |= {"is_subscription": True, "payment": {"installments_number": 3}}
    record["purchase"]["hotmart_fee"] |= {"percentage": 9.9, "base": "x"}
    sales_load(spark, tmp_path, mart, RUN, [record])
    columns = ("product_id", "is_subscription", "installments_number", "price_value", "fee_total", "fee_percentage", "fee_base", "valor_liquido")
    assert rows(mart.fact.read(), *columns) == [(1, True, 3, 10.5, 1.0, 9, None, 9.5)]


def test_a_failed_dimension_keeps_the_window_open(spark, rows, tmp_path, monkeypatch):
    mart = SalesMart(spark, str(tmp_path / "lake"))
    records = [sale("t1", dt.date(2023, 1, 1), "A", buyer="old"), sale("t2", dt.date(2024, 1, 1), "A", buyer="new")]
    broken = mart.dimensions["dim_cliente"]
    monkeypatch.setattr(broken, "merge", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        sales_load(spark, tmp_path, mart, RUN, records)
    assert not mart.fact.exists() and mart.dimensions["dim_produto"].exists()
    monkeypatch.undo()
    mart.to_gold()
    assert rows(broken.read(), "buyer_ucode") == [("new",), ("old",)] and mart.fact.read().count() == 2


# ---- snapshots ---------------------------------------------------------------------------


def test_subscriptions_pass_through_and_skip_when_empty(spark, rows, tmp_path):
    mart = SubscriptionsMart(spark, str(tmp_path))
    schema = "id string, plan struct<name: string>, items array<struct<k: string>>"
    mart.load(RUN, schema, arrays=True)
    assert not mart.fact.exists()
    land(tmp_path / "raw" / "subscriptions", RUN, "subscriptions_snapshot.json", [{"id": "1", "plan": {"name": "p"}, "items": [{"k": "ã"}]}])
    mart.load(RUN, schema, arrays=True)
    assert rows(mart.fact.read(), "id", "plan_name", "items") == [("1", "p", '[{"k":"ã"}]')]
    mart.load(next_run(1), schema, arrays=True)
    assert len(mart.bronze.versions()) == 1 and mart.fact.read().count() == 1


SHEET = """ID Venda,Nome do comprador,Email do comprador,Nome Afiliado,Data da venda,Valor Pago,ID Oferta,Nome da oferta,CPF/CNPJ
1,Ana,a@x,,2024-01-01 23:30:00,10.5,o1,Oferta,007
1,Ana,a@x,"",2024-01-02 00:00:00,x,o1,Oferta,007
1,Ana,a@x,"",2024-01-03 00:00:00,,o1,Oferta,007
445793,Ana,a@x,Zé,2024-01-02,1,o2,Fora,1
,Ana,a@x,Zé,2024-01-02,1,o2,Fora,1
3,,b@x,Zé,2024-01-02,1,o2,Fora,1
4,Bia,,Zé,2024-01-02,1,o2,Fora,1
"""


def sheet_mart(spark, tmp_path):
    return SheetSalesMart(spark, str(tmp_path), extensions=(".csv",))


def test_sheet_sales_quirks(spark, rows, tmp_path):
    mart = sheet_mart(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        mart.ingest(RUN)
    inbox = tmp_path / "stage" / "sheet_sales"
    inbox.mkdir(parents=True)
    (inbox / "b.csv").write_text(SHEET, encoding="utf-8")
    (inbox / "c.CSV").write_text("ID Venda,Nome do comprador,Email do comprador\n9,x,y\n", encoding="utf-8")
    (inbox / "~b.csv").write_text("broken", encoding="utf-8")
    assert mart.ingest(RUN) == 2
    assert [p.name for p in inbox.iterdir() if not p.name.startswith(".")] == ["~b.csv"]
    with pytest.raises(GateError, match="several drops"):
        mart.load()
    mart.first_only = True
    mart.load()
    # Only the first file of the newest drop; a null id goes with the excluded ones; duplicates stay.
    assert rows(mart.fact.read(), "ID Venda", "Data da venda", "Valor Pago") == sorted(
        [(1, dt.date(2024, 1, 1), 10.5), (1, dt.date(2024, 1, 3), None)], key=repr
    )
    # Bronze is the drop as it came; the row with an unreadable amount is among the rejects, whole.
    assert mart.bronze.read().count() == 7 and ("x",) in rows(mart.bronze.read(), "Valor Pago")
    assert rows(mart.rejects.read(), "ID Venda", "Valor Pago", "CPF/CNPJ") == [("1", "x", "007")]
    assert rows(mart.dimensions["dim_afiliado"].read()) == sorted(
        [("d41d8cd98f00b204e9800998ecf8427e", None), ("d41d8cd98f00b204e9800998ecf8427e", "")], key=repr
    )
    assert rows(mart.dimensions["dim_cliente"].read(), "Nome do comprador", "CPF/CNPJ") == [("Ana", "007")]
    assert mart.dimensions["dim_cliente"].read().columns == ["Nome do comprador", "Email do comprador", "ID_Cliente", "CPF/CNPJ"]
    assert rows(mart.dimensions["dim_oferta"].read()) == [("o1", "Oferta")]


def test_a_sheet_with_all_its_columns_is_planned_at_once(spark, tmp_path):
    names = spec.sheet_columns()
    assert len(names) == 43
    mart = sheet_mart(spark, tmp_path)
    row = {name: "2024-01-02" if name in (*spec.SHEET_TIMESTAMPS, *spec.SHEET_DATES) else "7" for name in names}
    spoilt = {**row, "Taxa de câmbio": "x"}
    frame = spark.createDataFrame([tuple(one.values()) for one in (row, spoilt)], ", ".join(f"`{name}` string" for name in names))
    frame.coalesce(1).write.option("header", "true").csv(f"{mart.raw_root}/ingestion_date=2024-02-01/vendas.csv")
    started = time.monotonic()
    flagged = snapshots.flag_misfits(mart.newest())
    flagged._jdf.queryExecution().executedPlan()
    assert time.monotonic() - started < 15
    mart.load()
    assert len(mart.fact.read().columns) == 35 and mart.fact.read().count() == 1 and mart.rejects.read().count() == 1


def test_a_bad_drop_stops_the_ingestion(spark, tmp_path):
    mart = sheet_mart(spark, tmp_path)
    inbox = tmp_path / "stage" / "sheet_sales"
    inbox.mkdir(parents=True)
    (inbox / "a.csv").write_text(SHEET, encoding="utf-8")
    (inbox / "b.csv").write_text("ID Venda,Nome do comprador\n1,x\n", encoding="utf-8")
    with pytest.raises(GateError, match="Email do comprador"):
        mart.ingest(RUN)
    (inbox / "b.csv").write_text("ID Venda,Nome do comprador,Email do comprador\n", encoding="utf-8")
    with pytest.raises(GateError, match="no rows"):
        mart.ingest(RUN)
    assert len(list(inbox.glob("*.csv"))) == 2
    with pytest.raises(FileNotFoundError):
        mart.load()


def test_a_branch_runs_only_when_something_arrived(spark, tmp_path):
    mart = sheet_mart(spark, tmp_path)
    assert not mart.run(RUN)
    inbox = tmp_path / "stage" / "sheet_sales"
    inbox.mkdir(parents=True)
    (inbox / "~lock.csv").write_text("x")
    assert not mart.run(RUN)
    (inbox / "a.csv").write_text(SHEET, encoding="utf-8")
    assert mart.run(RUN) and mart.fact.read().count() == 2
    assert not mart.run(next_run(1)) and len(mart.fact.versions()) == 1


def test_sheet_sales_from_workbooks_with_changing_columns(spark, rows, tmp_path):
    def decode(content):
        # Cells keep their own types, as in a workbook: numbers, dates, blanks and text side by side.
        frame = pd.read_json(io.BytesIO(content), dtype=False, convert_dates=["Data da venda"])
        return frame.astype(object).where(frame.notna(), None)

    mart = SheetSalesMart(spark, str(tmp_path), decode=decode)
    inbox = tmp_path / "stage" / "sheet_sales"
    inbox.mkdir(parents=True)
    sale_row = {"ID Venda": 7, "Nome do comprador": "Ana", "Email do comprador": "a@x", "Nome Afiliado": None}
    drops = [
        [{**sale_row, "Valor Pago": 10.5, "CPF/CNPJ": 123}, {**sale_row, "ID Venda": None, "Valor Pago": None, "CPF/CNPJ": "0-1"}],
        [{**sale_row, "Data da venda": "2024-01-02 23:00:00", "New column": "n"}],
    ]
    for n, drop in enumerate(drops):
        (inbox / "vendas.xlsx").write_text(json.dumps(drop), encoding="utf-8")
        assert mart.run(next_run(n))
    assert rows(mart.fact.read(), "ID Venda", "Data da venda") == [(7, dt.date(2024, 1, 2))]
    assert "New column" in mart.bronze.read().columns and "Valor Pago" not in mart.fact.read().columns
    older = mart.bronze.read(0)
    assert rows(older, "ID Venda", "Valor Pago", "CPF/CNPJ") == sorted([("7.0", "10.5", "123"), (None, None, "0-1")], key=repr)
    (inbox / "vendas.xlsx").write_text(json.dumps([{"ID Venda": 1}]), encoding="utf-8")
    with pytest.raises(GateError, match="Nome do comprador"):
        mart.run(next_run(5))


def test_projections(spark, rows, tmp_path):
    def decode(content):
        return pd.read_csv(io.BytesIO(content), dtype=str)

    mart = ProjectionsMart(spark, str(tmp_path), decode=decode)
    assert mart.ingest(RUN) == 0
    mart.load()
    assert not mart.fact.exists()
    inbox = tmp_path / "stage" / "projections"
    inbox.mkdir(parents=True)
    # The stand-in decoder reads CSV bytes, here under a workbook's name.
    (inbox / "p.xlsx").write_text('Mês,Valor Total\n DEZ/2024 ,"R$ 1.234,56"\nxyz/2025,10\n', encoding="utf-8")
    assert mart.ingest(RUN) == 1
    mart.load()
    assert rows(mart.fact.read()) == sorted([("01/12/2024", Decimal("1234.56")), (None, Decimal("10.00"))], key=repr)


# ---- jobs --------------------------------------------------------------------------------


def test_jobs_run_from_arguments(spark, rows, tmp_path):
    root, landing = str(tmp_path / "lake"), tmp_path / "api"
    land(landing / "ads", RUN, "a.json", [{"campaign_id": "c", "campaign_name": "n", "date_start": "2024-01-01", "spend": "1"}])
    land(landing / "sales", RUN, "s.json", [sale("t1", dt.date(2024, 1, 31), "APPROVED")])
    common = ["--root", root, "--date", RUN.isoformat(), "--arrays"]
    jobs.run(spark, jobs.arguments(["ads", "camp", "--landing", str(landing / "ads"), *common]))
    jobs.run(spark, jobs.arguments(["sales", "--landing", str(landing / "sales"), *common]))
    staged = tmp_path / "lake" / "stage" / "subscriptions"
    staged.mkdir(parents=True)
    (staged / "subscriptions_snapshot.json").write_text('[{"id": "1", "plan": {"name": "p"}}]')
    jobs.run(spark, jobs.arguments(["subscriptions", *common]))
    assert rows(SubscriptionsMart(spark, root).fact.read()) == [("1", "p")]
    jobs.run(spark, jobs.arguments(["sheet", *common]))
    jobs.run(spark, jobs.arguments(["projections", *common]))
    jobs.run(spark, jobs.arguments(["maintain", *common]))
    assert rows(AdsMart(spark, root, "camp").dimension.read()) == [("c", "n")]
    assert rows(SalesMart(spark, root).fact.read(), "transaction") == [("t1",)]
    assert len(all_tables(spark, root)) == 3 * 4 + 8 + 3 + 8 + 2
    for wrong in (["ads", "--root", root], ["sales", "--root", root], ["ads", "sales", "--root", root, "--landing", root]):
        with pytest.raises(SystemExit):
            jobs.arguments(wrong)


# ---- serving -----------------------------------------------------------------------------


def test_every_gold_table_has_a_served_schema(spark, tmp_path):
    views = serving.serving_ddl()
    assert len(views) == 6 + 5 + 5 + 1
    for ddl in views.values():
        assert spark.createDataFrame([], ddl).columns
    mart = SalesMart(spark, str(tmp_path / "lake"))
    sales_load(spark, tmp_path, mart, RUN, [sale("t1", dt.date(2024, 1, 31), "APPROVED")])
    served = serving.serve(spark, "sales_f_vendas", mart.fact.read())
    assert dict(served.dtypes)["fee_percentage"] == "int" and dict(served.dtypes)["data"] == "date"
    assert spark.sql("select count(*) from sales_f_vendas").first()[0] == 1
    serving.serve(spark, "sales_f_vendas", mart.fact.read().where(F.lit(False)))
    assert spark.sql("select count(*) from sales_f_vendas").first()[0] == 0


def test_lookups_reach_the_jobs_and_stay_where_a_later_run_has_none(spark, rows, tmp_path):
    root, landing = str(tmp_path / "lake"), tmp_path / "api"
    records = [{"adset_id": "s1", "campaign_id": "c", "adset_name": "n", "date_start": "2024-01-01", "clicks": 1}]
    tables = landing / "audiences"
    tables.mkdir(parents=True)
    targeting = {"custom_audiences": [{"id": "1", "name": "Everyone"}], "flexible_spec": None}
    (tables / "a.json").write_text(json.dumps({"id": "s1", "targeting": targeting}) + "\n", encoding="utf-8")
    for n, lookup in enumerate((["--audiences", str(tables)], [])):
        run = next_run(n)
        land(landing / "ads", run, "a.json", [{**records[0], "adset_name": f"n{n}"}])
        given = ["ads", "adset", "--root", root, "--date", run.isoformat(), "--arrays", "--landing", str(landing / "ads"), *lookup]
        jobs.run(spark, jobs.arguments(given))
        assert rows(AdsMart(spark, root, "adset").dimension.read()) == [("s1", f"n{n}", "Everyone")]
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 8


def test_the_landing_records_are_gated_while_they_are_staged(spark, tmp_path, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    mart = AdsMart(spark, str(tmp_path / "lake"), "ad")
    schema = insight_schema(mart.level)
    rows = [{**{field.name: None for field in schema.fields}, "ad_id": f"a{i}", "date_start": "2024-01-05", "clicks": "1"} for i in range(10)]
    frame = spark.createDataFrame([tuple(row.values()) for row in rows], schema)
    mart.stage(frame.withColumn("ad_id", counted.asNondeterministic()("ad_id")))
    assert read.value == 10 and (tmp_path / "lake" / "stage" / "ads" / "ad").exists()
    with pytest.raises(GateError, match=r"without ad_id: 2024-01-05 \(10\)"):
        mart.stage(frame.withColumn("ad_id", F.lit(None).cast("string")))
    assert not (tmp_path / "lake" / "stage" / "ads" / "ad").exists()


def test_served_tables_have_declared_types_and_statistics(spark, tmp_path):
    for n in (3, 5):
        frame = spark.range(n).selectExpr("cast(id as string) as Data", "cast(id as decimal(38,2)) as Valor", "1 as more")
        served = serving.serve_table(spark, "sheet_projetadas", frame, str(tmp_path / f"v{n}"))
        assert dict(served.dtypes) == {"Data": "string", "Valor": "decimal(18,2)"} and served.count() == n
    described = {row["col_name"]: row["data_type"] for row in spark.sql("describe extended sheet_projetadas").collect()}
    assert "5 rows" in described["Statistics"] and described["Type"] == "EXTERNAL"
    column = {row["info_name"]: row["info_value"] for row in spark.sql("describe extended sheet_projetadas Valor").collect()}
    assert column["distinct_count"] == "5" and column["max"] == "4.00"
    spark.sql("drop table sheet_projetadas")


def test_a_first_load_of_rejects_creates_no_table(spark, rows, tmp_path):
    mart = AdsMart(spark, str(tmp_path / "lake"), "ad")
    ads_load(spark, tmp_path, mart, RUN, [insight("2024-13-05", "a1", "1")])
    assert not any(table.exists() for table in mart.tables())
    ads_load(spark, tmp_path, mart, next_run(1), [insight("2024-01-05", "a1", "1")])
    assert rows(mart.fact.read(), "ad_id", "spend") == [("a1", 1.0)]
    # Nobody looked its links up: null, not "no link".
    assert rows(mart.dimension.read(), "ad_id", "video_url") == [("a1", None)]


def test_the_extraction_window_of_a_job(spark, tmp_path, capsys):
    given = ["window", "camp", "--root", str(tmp_path), "--date", "2024-03-01", "--first", "2024-02-25"]
    jobs.run(spark, jobs.arguments(given))
    jobs.run(spark, jobs.arguments([*given, "--last", "2024-02-26"]))
    assert capsys.readouterr().out.splitlines() == ["2024-02-25 2024-03-01", "2024-02-25 2024-02-26"]
