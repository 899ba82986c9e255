"""Customers by changed keys: each table is filtered on its own date in its scan."""

from datetime import datetime

import pytest
from conftest import BOTH_LIMITS, rows
from pyspark.sql import functions as F
from test_batches import plan_of

from starloom import plans
from starloom.plans.dimensions import changed_people

LOW, HIGH, RUN = datetime(2024, 1, 10), datetime(2024, 1, 20), datetime(2024, 2, 1)


def day(n):
    return None if n is None else datetime(2024, 1, n)


@pytest.fixture
def tables(spark, tmp_path):
    """Every mix of a person and an e-mail changed before, in and after the window, or never."""
    moments = [None, 5, 15, 25]
    people, mails, buyers = [], [], []
    for k, (p, e) in enumerate([(p, e) for p in moments for e in [*moments, "absent"]]):
        buyers.append((1000 + k, k))
        people.append((k, "T", f"n{k}", "L", "M", "S", day(p)))
        if e != "absent":
            mails.append((k, f"m{k}", day(e)))
    buyers += [(2000, None), (2001, 999)]
    shape = "BusinessEntityID int, Title string, FirstName string, LastName string, MiddleName string, Suffix string, ModifiedDate timestamp"
    frames = {
        "person": spark.createDataFrame([*people, (None, "T", "nobody", "L", "M", "S", day(15))], shape),
        "email": spark.createDataFrame(mails, "BusinessEntityID int, EmailAddress string, ModifiedDate timestamp"),
        "customer": spark.createDataFrame(buyers, "CustomerID int, PersonID long"),
    }
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    return [spark.read.parquet(str(tmp_path / n)) for n in ("customer", "person", "email")]


def test_both_scans_filter_on_their_date(tables):
    _, person, email = tables
    plan = plan_of(changed_people(person, email, LOW))
    scans = [part.split("ReadSchema")[0] for part in plan.split("PushedFilters: [")[1:]]
    assert len(scans) == 2 and all("GreaterThan(ModifiedDate" in s for s in scans)


@BOTH_LIMITS
@pytest.mark.parametrize("strict", [False, True])
def test_same_customers_as_the_filter_on_joined_rows(tables, strict, limits):
    customer, person, email = tables
    got = plans.customer_dimension(customer, person, email, LOW, HIGH, RUN, strict, limits)
    p, e = F.col("p.ModifiedDate"), F.col("e.ModifiedDate")
    joined = customer.alias("c").join(person.alias("p"), F.expr("c.PersonID = p.BusinessEntityID"))
    joined = joined.join(email.alias("e"), F.expr("p.BusinessEntityID = e.BusinessEntityID"), "left")
    newest = F.greatest(p, e)
    kept = (newest > LOW) & (newest <= HIGH) if strict else ((p > LOW) | (e > LOW)) & ((p <= HIGH) | (e <= HIGH))
    want = joined.filter(kept).select("c.CustomerID", "p.FirstName", "e.EmailAddress")
    assert rows(got, "CustomerAK", "FirstName", "EmailAddress") == rows(want)
    assert len(rows(want)) > 3
