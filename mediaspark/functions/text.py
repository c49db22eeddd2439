"""String columns: device system, e-mail check, separators, budgets, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# User-agent patterns by operating system. The first that matches wins;
# an Android agent also names Linux, so the order matters.
DEVICE_SYSTEMS = (
    ("iOS", "(?i)iphone|ios"),
    ("Android", "(?i)android"),
    ("Windows", "(?i)windows"),
    ("macOS", "(?i)macintosh|mac os"),
    ("Linux", "(?i)linux|tizen"),
)
OTHER_SYSTEM = "Other"

# Accepted e-mail form, genre separators, currency of a bare number, label width.
EMAIL_FORM = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
GENRE_SEPARATOR = r"\s*[,|]\s*"
CAST_SEPARATOR = r"\|"
HOME_CURRENCY = "INR"
LABEL_WIDTH = 30


def device_system(agent: Column) -> Column:
    """Operating system named by a user agent; ``Other`` for none or null."""
    named = [F.when(agent.rlike(pattern), F.lit(name)) for name, pattern in DEVICE_SYSTEMS]
    return F.coalesce(*named, F.lit(OTHER_SYSTEM))


def is_email(address: Column) -> Column:
    """Whether the address has the accepted form; null stays null."""
    return address.rlike(EMAIL_FORM)


def genre_list(text: Column) -> Column:
    """Array of genres from text that mixes commas and pipes.

    Empty parts are kept, and so is white space around the whole text.
    """
    return F.split(text, GENRE_SEPARATOR)


def cast_list(text: Column) -> Column:
    return F.split(text, CAST_SEPARATOR)


def tidy_title(title: Column, strip_whitespace: bool = False) -> Column:
    """Trim spaces; ``strip_whitespace`` also takes tabs and line ends away."""
    return F.regexp_replace(title, r"^\s+|\s+$", "") if strip_whitespace else F.trim(title)


def budget_currency(budget: Column) -> Column:
    """Leading letters of a budget such as ``USD 1200``, else the home currency."""
    letters = F.regexp_extract(budget, "^[A-Za-z]+", 0)
    return F.when(F.length(letters) > 0, letters).otherwise(F.lit(HOME_CURRENCY))


def budget_amount(budget: Column) -> Column:
    """Closing digits of a lettered budget, else the whole number; null where unreadable.

    A bare number may carry decimals, which are cut off.
    """
    digits = F.when(budget.rlike("^[A-Za-z]"), F.regexp_extract(budget, r"\d+$", 0)).otherwise(
        F.regexp_replace(budget, r"^(\s*[+-]?\d+)\.\d*\s*$", "$1")
    )
    return digits.try_cast("bigint")


def chart_label(title: Column) -> Column:
    """Title cut for a chart axis; it stands beside the title, not in its place."""
    return F.substring(title, 1, LABEL_WIDTH)
