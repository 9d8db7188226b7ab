"""CSV as spreadsheet and data-frame tools write it: names, quotes, line breaks, integers as 1996.0."""

import csv
import glob
import os
import tempfile
from collections import Counter
from decimal import Decimal

import pytest

from conftest import SMALL
from ledgerline import schemas
from ledgerline.operators import crm_export
from ledgerline.sources import bindings as b
from ledgerline.sources import files


def write(text):
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-csv-"), "x.csv")
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


def test_columns_by_name_quotes_and_integers_with_a_point(spark):
    path = write('employees,note,account,sector,subsidiary_of,office_location,revenue,year_established\n'
                 '12.0,x,"Big ""X"", Inc",tech,,"line\nbreak",1.50,1996.0\n,,"  b ",,,,,\n')
    rows = files.read_csv(spark, path, schemas.ACCOUNTS, "accounts").collect()
    assert [f.name for f in schemas.ACCOUNTS.fields] == list(rows[0].asDict())
    assert rows[0]["account"] == 'Big "X", Inc' and rows[0]["office_location"] == "line\nbreak"
    assert rows[0]["year_established"] == 1996 and rows[0]["employees"] == 12 and rows[0]["revenue"] == Decimal("1.50")
    assert rows[1]["account"] == "  b " and rows[1]["year_established"] is None and rows[1]["sector"] is None


@pytest.mark.parametrize("value", ["1996.5", "soon"])
def test_malformed_values_fail(spark, value):
    path = write(f"account,sector,year_established,revenue,employees,office_location,subsidiary_of\na,b,{value},1,1,c,\n")
    with pytest.raises(Exception, match="year_established"):
        files.read_csv(spark, path, schemas.ACCOUNTS, "accounts").collect()


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="accounts: sector"):
        files.read_csv(spark, write("account,year_established,revenue,employees,office_location,subsidiary_of\n"), schemas.ACCOUNTS, "accounts")


def test_written_files_read_back_equal_elsewhere_and_here(spark):
    names = ['plain', 'q"uote', 'a,b', 'line\nbreak', ' spaces ', '"', 'x"",\n"y']
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, k int")
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerline-csv-"), "out")
    files.write_csv(df, out)
    found = []
    for part in glob.glob(f"{out}/part-*"):
        with open(part, newline="", encoding="utf-8") as f:
            found += [(r["name"], int(r["k"])) for r in csv.DictReader(f)]
    assert sorted(found) == sorted((n, i) for i, n in enumerate(names))
    assert Counter(files.read_csv(spark, out, df.schema).collect()) == Counter(df.collect())


def test_id_list_with_other_columns(spark):
    ids = files.read_csv(spark, write('Owner,Id,Name\nme,001,"Big ""X"", Inc"\nyou,002,\n'), schemas.EXTERNAL_IDS,
                         "ids", extra_columns=True)
    opps = spark.createDataFrame([("o", 'Big "X", Inc', Decimal("1.00"), "2024-01-01", "Won", "p", "a", "OPP-1")],
                                 "`Opportunity Name` string, `Account Name` string, Amount decimal(38,2), `Close Date` string, Stage string, "
                                 "Product string, `Sales Agent` string, Opportunity_ID__c string")
    row = crm_export.attach_external_ids(opps, ids).first()
    assert row["AccountId"] == "001" and row["Owner"] == "me"


def test_exported_marts_hold_the_same_cells(spark):
    from ledgerline.jobs import MARTS

    t = b.tables(spark, SMALL)
    marts = {name: fn(t) for name, fn in MARTS.items()}
    paths = files.export_marts(marts, tempfile.mkdtemp(prefix="ledgerline-marts-"), single_file=True)
    for name, df in marts.items():
        assert Counter(files.read_csv(spark, paths[name], df.schema, name).collect()) == Counter(df.collect())
    assert len(glob.glob(f"{paths['vw_agent_scorecard']}/part-*")) == 1
