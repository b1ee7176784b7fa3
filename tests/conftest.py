import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankwatch.config import Config  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL_DIR = "/root/testdata/sf0.001"

# One template row per kind of customer; generated frames repeat them.
TEMPLATES = [
    ("Male", 24, "Multan", "Diploma", "Employed", 40000.0, 1200.0, 12.0, 100.0, "Monthly", 1,
     "Coverage seems alright", 0),
    ("Female", 48, "Quetta", "Degree", "Employed", 55000.0, 1500.0, 18.0, 120.0, "Half-year", 4,
     "Billing mistakes each month", 1),
    ("Female", 36, "Quetta", "Diploma", "Freelance", 32000.0, 900.0, 7.0, 80.0, "Monthly", 3,
     "Support was not helpful", 1),
    ("Male", 52, "Multan", "Degree", "Retired", 18000.0, 2500.0, 4.0, 30.0, "Monthly", 0,
     "All good here", 0),
]
COLUMNS = (
    "customer_id long, signup_date date, gender string, age int, city string,"
    " education_level string, employment_status string, monthly_income double,"
    " monthly_bill double, internet_usage_gb double, call_minutes double, contract_type string,"
    " support_tickets int, customer_feedback string, churn int"
)


def rows(n):
    out = []
    for i in range(n):
        r = list(TEMPLATES[i % len(TEMPLATES)])
        r[5] += 500 * i
        r[6] += 50 * i
        day = dt.date(2024, 1, 1) + dt.timedelta(days=i % 28)
        out.append((10000 + i, day, *r))
    return out


@pytest.fixture()
def frame(spark):
    """frame(n): n generated customers."""
    return lambda n: spark.createDataFrame(rows(n), COLUMNS)


@pytest.fixture()
def cfg():
    return Config()


@pytest.fixture()
def small_cfg():
    """The split used for tiny tables."""
    return Config(test_size=0.25, validation_size=0.25, top_k=3)


@pytest.fixture()
def write_csv(tmp_path):
    """write_csv(name, lines): a CSV file of the given text lines."""

    def write(name, lines, bom=False):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = "\n".join(lines) + "\n"
        path.write_text(text, encoding="utf-8-sig" if bom else "utf-8")
        return str(path)

    return write


HEADER = (
    "customer_id,signup_date,age,gender,city,education_level,employment_status,monthly_income,"
    "monthly_bill,internet_usage_gb,call_minutes,contract_type,support_tickets,customer_feedback"
)


def csv_lines(n, target=True):
    lines = [HEADER + (",churn" if target else "")]
    for r in rows(n):
        (cid, day, gender, age, city, edu, emp, inc, bill, gb, minutes, kind, tickets, text, y) = r
        cells = [cid, day, age, gender, city, edu, emp, inc, bill, gb, minutes, kind, tickets,
                 f'"{text}"'] + ([y] if target else [])
        lines.append(",".join(map(str, cells)))
    return lines
