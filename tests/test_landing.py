"""Three days over a landing folder: oldest first, repeats and broken files refused."""

import datetime as dt
import os
import time

import pytest
from xlsx import write_xlsx

from fraudlake.plans import daily
from fraudlake.plans import warehouse as W
from fraudlake.schemas import ACCOUNTS, TERMINALS
from fraudlake.sources import jdbc, workbook

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def feed(folder, day, lines):
    with open(f"{folder}/transactions_{day}012024.txt", "w") as f:
        f.write(HEADER + "".join(lines))


def line(i, day, amount="10,00"):
    return f"{i};2024-01-{day} 10:00:00;{amount};C1;pay;SUCCESS;T1\n"


def ids(spark, wh):
    return sorted(r["transaction_id"] for r in W.read_fact(spark, wh).collect())


def test_three_days(spark, scratch):
    land, wh = f"{scratch}/landing", W.Warehouse(f"{scratch}/wh")
    os.makedirs(land)
    term = ["terminal_id", "terminal_type", "terminal_city", "terminal_address"]
    for day in ("16", "17"):
        feed(land, day, [line(day, day)])
        write_xlsx(f"{land}/terminals_{day}012024.xlsx", [term, [f"T{day}", "ATM", "M", "a"], [None, "POS", "K", "b"]])
    write_xlsx(f"{land}/passport_blacklist_16012024.xlsx",
               [["date", "passport"], ["2024-01-01", "PP1"], ["soon", "PP2"], ["2024-01-02", None]])
    with open(f"{land}/passport_blacklist_17012024.xlsx", "wb") as f:
        f.write(b"not a workbook")

    got = daily.run_landing(spark, wh, land, dt.datetime(2024, 1, 16))
    assert got == {"transactions": "transactions_16012024.txt", "terminals": "terminals_16012024.xlsx",
                   "passport_blacklist": "passport_blacklist_16012024.xlsx"}
    assert ids(spark, wh) == ["16"] and [r["passport"] for r in W.read_blacklist(spark, wh).collect()] == ["PP1"]
    assert sorted(r["reason"] for r in W.read_rejects(spark, wh).collect()) == [
        "bad date", "missing passport", "missing terminal_id"]

    # day 2: the blacklist workbook is broken, the other feeds go on
    got = daily.run_landing(spark, wh, land, dt.datetime(2024, 1, 17))
    assert got == {"transactions": "transactions_17012024.txt", "terminals": "terminals_17012024.xlsx"}
    assert ids(spark, wh) == ["16", "17"] and W.read_blacklist(spark, wh).count() == 1
    assert any(r["reason"].startswith("unreadable file") for r in W.read_rejects(spark, wh).collect())
    assert sorted(r["terminal_id"] for r in W.read_dim(spark, wh, TERMINALS).filter("deleted_flg = 'N'").collect()) \
        == ["T16", "T17"]

    # day 3: a loaded name comes again with other content, and a new file
    time.sleep(1.1)
    feed(land, "16", [line(99, "16")])
    feed(land, "18", [line(18, "18"), line(19, "18", "bad")])
    got = daily.run_landing(spark, wh, land, dt.datetime(2024, 1, 18), on_bad="file")
    assert got == {"transactions": "transactions_18012024.txt"}
    assert ids(spark, wh) == ["16", "17"]                 # the file with a bad line is refused as a whole
    assert [tuple(r) for r in W.read_refused(spark, wh).collect()] == [
        ("transactions_16012024.txt", daily.REPEATED_FILE)]
    assert daily.run_landing(spark, wh, land, dt.datetime(2024, 1, 19)) == {}
    assert W.read_refused(spark, wh).count() == 1


def test_sliced_bank_needs_bounds_and_keeps_wall_times(spark):
    url, props = "jdbc:derby:memory:bank_ntz;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = [(f"A{i}", dt.datetime(2030, 1, 1), str(i), dt.datetime(2023, 1, 1 + i), None) for i in range(20)]
    src = spark.createDataFrame(rows, ACCOUNTS.source)
    src.toDF(*[c.upper() for c in src.columns]).write.mode("overwrite").options(**props).jdbc(url, "ACCOUNTS")
    with pytest.raises(ValueError, match="bounds"):
        jdbc.live_keys(spark, url, "ACCOUNTS", ACCOUNTS, props, "create_dt")
    part = ("create_dt", ("2023-01-01 00:00:00", "2023-01-21 00:00:00"), 4)
    keys = jdbc.live_keys(spark, url, "ACCOUNTS", ACCOUNTS, props, *part, "derby")
    assert keys.rdd.getNumPartitions() == 4 and keys.count() == 20
    got = jdbc.extract_since(spark, url, "ACCOUNTS", ACCOUNTS, None, "derby", props, *part)
    assert dict(got.dtypes)["create_dt"] == "timestamp_ntz"


def test_cells_without_places_and_sheet_order(tmp_path):
    import io
    import zipfile
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = f'<worksheet xmlns="{main}"><sheetData><row><c t="inlineStr"><is><t>%s</t></is></c><c><v>7</v></c></row></sheetData></worksheet>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                   '<sheet name="a" r:id="r2"/><sheet name="b" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/>'
                   '<Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", sheet % "second")
        z.writestr("xl/worksheets/sheet2.xml", sheet % "first")
    assert workbook.sheet_rows(buf.getvalue()) == [["first", "7"]]


def test_stream_remembers_files_over_applications(spark, scratch):
    from fraudlake.streaming.intake import run_intake
    land, wh = f"{scratch}/in", W.Warehouse(f"{scratch}/wh")
    os.makedirs(land)
    feed(land, "16", [line(1, "16")])
    assert run_intake(spark, wh, land) == 1
    assert run_intake(spark, wh, land) == 0      # the checkpoint lies under the warehouse, not in a session folder
    assert ids(spark, wh) == ["1"]
