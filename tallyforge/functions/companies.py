"""Industry and size of a company from typed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.rules import first_match, first_match_sql
from tallyforge.functions.text import squeeze, squeeze_sql

# Industry patterns in the order in which they are tried.
INDUSTRIES = (
    (r"(?i)\bsoft.*dev.*\b", "Software Development"), (r"(?i)\btech.*\b", "Technology"), (r"(?i)\bsoftware\b", "Software Development"),
    (r"(?i)\binformation.*tech.*\b", "Information Technology"), (r"(?i)\bIT\b", "Information Technology"),
    (r"(?i)\bcomputer.*soft.*\b", "Software Development"), (r"(?i)\bpharma.*\b", "Pharmaceutical Manufacturing"),
    (r"(?i)\bbiotech.*\b", "Biotechnology"), (r"(?i)\bhealth.*care\b", "Healthcare"), (r"(?i)\bmedical.*\b", "Healthcare"),
    (r"(?i)\bhospital.*\b", "Healthcare"), (r"(?i)\bfin.*serv.*\b", "Financial Services"), (r"(?i)\bbanking\b", "Financial Services"),
    (r"(?i)\binvestment\b", "Financial Services"), (r"(?i)\binsurance\b", "Insurance"), (r"(?i)\bconsult.*\b", "Consulting"),
    (r"(?i)\blegal.*serv.*\b", "Legal Services"), (r"(?i)\baccounting\b", "Accounting"), (r"(?i)\bmanufact.*\b", "Manufacturing"),
    (r"(?i)\bindustrial\b", "Manufacturing"), (r"(?i)\bautomotive\b", "Automotive"), (r"(?i)\bretail\b", "Retail"),
    (r"(?i)\be-commerce\b", "E-commerce"), (r"(?i)\becommerce\b", "E-commerce"), (r"(?i)\bconsumer.*goods\b", "Consumer Goods"),
    (r"(?i)\breal.*estate\b", "Real Estate"), (r"(?i)\beducation\b", "Education"), (r"(?i)\bmedia\b", "Media & Communications"),
    (r"(?i)\bentertain.*\b", "Entertainment"), (r"(?i)\bhospitality\b", "Hospitality"), (r"(?i)\brestaurant\b", "Food Services"),
    (r"(?i)\btravel\b", "Travel & Tourism"), (r"(?i)\benergy\b", "Energy"), (r"(?i)\butilities\b", "Utilities"),
    (r"(?i)\bgovernment\b", "Government"), (r"(?i)\bnon.*profit\b", "Non-Profit"), (r"(?i)\bsports\b", "Sports & Recreation"),
)


def industry(c: Column) -> Column:
    t = squeeze(c)
    return first_match(t, INDUSTRIES, t)


def industry_sql(e: str) -> str:
    return first_match_sql(squeeze_sql(e), INDUSTRIES, squeeze_sql(e))


def least_size(c: Column) -> Column:
    """The first number of a range such as 51-200, null without one."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).try_cast("long")


def size_class(c: Column) -> Column:
    n = least_size(c)
    return F.when(n.isNull(), "Unknown").when(n <= 50, "Startup").when(n <= 500, "Small").when(n <= 5000, "Medium").otherwise("Large")
