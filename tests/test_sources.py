import datetime as dt
import os
from decimal import Decimal


from fraudlake.plans import warehouse as W
from fraudlake.schemas import ACCOUNTS
from fraudlake.sources import intake, jdbc, manifest, workbook
from fraudlake.streaming.intake import run_intake
from xlsx import write_xlsx

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_typing_and_rejects(spark, scratch):
    write(f"{scratch}/transactions_16012024.txt", HEADER +
          "1;2024-01-16 10:00:00;1234,56;C1;pay;SUCCESS;T1\n"
          "2;2024-01-16 10:00:01;12,5;  C2  ;pay;REJECT;\n"
          "3;2024-01-16 10:00:02;abc;C3;pay;SUCCESS;T1\n"
          "4;not a time;1,00;C4;pay;SUCCESS;T1\n"
          "5;2024-01-16 10:00:03\n"
          "1;2024-01-16 10:00:00;1234,56;C1;pay;SUCCESS;T1\n")
    write(f"{scratch}/transactions_17012024.txt", HEADER + "9;2024-01-17 08:00:00;7,00;C9;pay;SUCCESS;T9\n")
    raw = intake.read_transactions_csv(spark, f"{scratch}/transactions_*.txt")
    good, bad = intake.type_transactions(raw)
    g = {r["transaction_id"]: r for r in good.collect()}
    assert g["1"]["amount"] == Decimal("1234.56")
    assert g["2"]["card_num"] == "C2" and g["2"]["terminal"] is None
    assert g["2"]["transaction_date"] == dt.datetime(2024, 1, 16, 10, 0, 1)
    reasons = sorted((r["file_name"], r["reason"]) for r in bad.collect())
    assert reasons == [("transactions_16012024.txt", "bad amount"),
                       ("transactions_16012024.txt", "bad transaction_date"),
                       ("transactions_16012024.txt", "malformed line")]
    good_f, _ = intake.type_transactions(raw, on_bad="file")
    assert sorted(r["transaction_id"] for r in good_f.collect()) == ["9"]


def test_fact_append_is_idempotent(spark, scratch):
    write(f"{scratch}/transactions_16012024.txt", HEADER +
          "1;2024-01-16 10:00:00;1,00;C1;pay;SUCCESS;T1\n1;2024-01-16 10:00:00;1,00;C1;pay;SUCCESS;T1\n"
          "2;2024-01-16 11:00:00;2,00;C1;pay;SUCCESS;T1\n")
    wh = W.Warehouse(f"{scratch}/wh")
    good, _ = intake.type_transactions(intake.read_transactions_csv(spark, f"{scratch}/transactions_*.txt"))
    W.append_transactions(spark, wh, good)
    W.append_transactions(spark, wh, good)   # replay of the same file
    fact = W.read_fact(spark, wh)
    assert sorted(r["transaction_id"] for r in fact.collect()) == ["1", "2"]


def test_workbooks(spark, scratch):
    write_xlsx(f"{scratch}/passport_blacklist_16012024.xlsx",
               [["date", "passport"], [45306, "PP1"], ["2024-01-10", "PP2"]])
    write_xlsx(f"{scratch}/terminals_16012024.xlsx",
               [["terminal_id", "terminal_type", "terminal_city", "terminal_address"],
                ["T1", "ATM", "Moscow", "addr 1"], ["T2", "POS", "Kazan", "addr 2"]])
    bl = {r["passport"]: r["entry_dt"] for r in
          workbook.read_blacklist(spark, f"{scratch}/passport_blacklist_*.xlsx").collect()}
    assert bl == {"PP1": dt.datetime(2024, 1, 15), "PP2": dt.datetime(2024, 1, 10)}
    t = workbook.read_terminals(spark, f"{scratch}/terminals_*.xlsx").collect()
    assert sorted((r["terminal_id"], r["terminal_city"], r["update_dt"]) for r in t) == [
        ("T1", "Moscow", dt.datetime(2024, 1, 16)), ("T2", "Kazan", dt.datetime(2024, 1, 16))]


def test_jdbc_extract_and_keys(spark):
    url = "jdbc:derby:memory:bank_test;create=true"
    rows = [("A1", dt.datetime(2030, 1, 1), "1", dt.datetime(2023, 12, 1), None),
            ("A2", dt.datetime(2030, 1, 1), "2", dt.datetime(2023, 12, 1), dt.datetime(2024, 1, 14, 12)),
            ("A3", dt.datetime(2030, 1, 1), "3", dt.datetime(2024, 1, 10), None)]
    src = spark.createDataFrame(rows, ACCOUNTS.source)
    src = src.toDF(*[c.upper() for c in src.columns])   # unquoted identifiers, as a bank schema has
    src.write.mode("overwrite").option("driver", "org.apache.derby.jdbc.EmbeddedDriver").jdbc(url, "ACCOUNTS")
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    got = jdbc.extract_since(spark, url, "ACCOUNTS", ACCOUNTS, dt.datetime(2024, 1, 2), "derby", props)
    assert sorted(r["account"] for r in got.collect()) == ["A2", "A3"]
    keys = jdbc.live_keys(spark, url, "ACCOUNTS", ACCOUNTS, props)
    assert keys.count() == 3


def test_file_stream_intake(spark, scratch):
    landing, wh = f"{scratch}/landing", W.Warehouse(f"{scratch}/wh")
    os.makedirs(landing)
    write(f"{landing}/transactions_16012024.txt", HEADER + "1;2024-01-16 10:00:00;1,00;C1;pay;SUCCESS;T1\n")
    write(f"{landing}/transactions_17012024.txt", HEADER + "2;2024-01-17 10:00:00;2,00;C1;pay;SUCCESS;T1\n"
          "3;2024-01-17 10:00:00;bad;C1;pay;SUCCESS;T1\n")
    ckpt = f"{scratch}/ckpt"
    run_intake(spark, wh, landing, checkpoint=ckpt)
    assert W.read_fact(spark, wh).count() == 2
    write(f"{landing}/transactions_18012024.txt", HEADER + "4;2024-01-18 10:00:00;4,00;C1;pay;SUCCESS;T1\n")
    run_intake(spark, wh, landing, checkpoint=ckpt)
    run_intake(spark, wh, landing, checkpoint=ckpt)   # nothing new
    assert sorted(r["transaction_id"] for r in W.read_fact(spark, wh).collect()) == ["1", "2", "4"]
    rej = W.read_rejects(spark, wh)
    assert [r["reason"] for r in rej.collect()] == ["bad amount"]


def test_manifest_listing(spark, scratch):
    land, arch = f"{scratch}/all", f"{scratch}/archive"
    os.makedirs(land)
    os.makedirs(arch)
    for n in ["transactions_16012024.txt", "transactions_15012024.txt", "terminals_17012024.xlsx",
              "passport_blacklist_15012024.xlsx"]:
        write(f"{land}/{n}", "x")
    write(f"{arch}/transactions_15012024.txt.backup", "x")
    m = manifest.list_files(spark, land)
    oldest = {r["kind"]: r["file_name"] for r in manifest.oldest_batch(m).collect()}
    assert oldest == {"transactions": "transactions_15012024.txt", "terminals": "terminals_17012024.xlsx",
                      "passport_blacklist": "passport_blacklist_15012024.xlsx"}
    archive = manifest.list_files(spark, arch).select("file_name")
    assert [r["file_name"] for r in manifest.already_loaded(m, archive).collect()] == ["transactions_15012024.txt"]
    assert manifest.unseen(m, archive).count() == 3


def test_stream_archives_processed_files(spark, scratch):
    landing, archive, wh = f"{scratch}/in", f"{scratch}/archive", W.Warehouse(f"{scratch}/wh")
    os.makedirs(landing)
    for day in ("16", "17"):
        write(f"{landing}/transactions_{day}012024.txt",
              HEADER + f"{day};2024-01-{day} 10:00:00;1,00;C1;pay;SUCCESS;T1\n")
    ckpt = f"{scratch}/ckpt"
    run_intake(spark, wh, landing, archive=archive, checkpoint=ckpt)
    write(f"{landing}/transactions_18012024.txt", HEADER + "18;2024-01-18 10:00:00;1,00;C1;pay;SUCCESS;T1\n")
    run_intake(spark, wh, landing, archive=archive, checkpoint=ckpt)
    archived = [n for _, _, fs in os.walk(archive) for n in fs if n.endswith(".txt")]
    assert "transactions_16012024.txt" in archived and "transactions_17012024.txt" in archived
    assert W.read_fact(spark, wh).count() == 3


def test_jdbc_extract_in_parallel_slices(spark):
    url = "jdbc:derby:memory:bank_slices;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = [(f"A{i}", dt.datetime(2030, 1, 1), str(i), dt.datetime(2023, 1, 1) + dt.timedelta(days=7 * i), None)
            for i in range(60)]
    src = spark.createDataFrame(rows, ACCOUNTS.source)
    src.toDF(*[c.upper() for c in src.columns]).write.mode("overwrite").options(**props).jdbc(url, "ACCOUNTS")
    wm = dt.datetime(2023, 6, 1)
    one = jdbc.extract_since(spark, url, "ACCOUNTS", ACCOUNTS, wm, "derby", props)
    sliced = jdbc.extract_since(spark, url, "ACCOUNTS", ACCOUNTS, wm, "derby", props,
                                partition_column="create_dt",
                                bounds=("2023-01-01 00:00:00", "2024-03-01 00:00:00"), partitions=4)
    assert sliced.rdd.getNumPartitions() == 4
    assert sorted(r["account"] for r in sliced.collect()) == sorted(r["account"] for r in one.collect())
    assert one.count() == sum(1 for r in rows if r[3] >= wm)
