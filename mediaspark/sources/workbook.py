"""Workbooks (.xlsx), decoded on the executors, one file per task at a time.

A sheet holds at most 1,048,576 rows by the format's own limit, so one file is a bounded
piece of work; many workbooks spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediaspark import schemas

BATCH_ROWS = 10_000


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType = schemas.CAMPAIGNS) -> DataFrame:
    """First sheet of each workbook, header in its first row, every column as text.

    ``schema`` names the columns to keep; one that a sheet lacks is null. Date cells come
    as ISO dates. Columns are matched by header.
    """
    columns = schema.names
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("content")
    text_schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    rows = files.mapInPandas(_decoder(columns, BATCH_ROWS), text_schema)
    return rows.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields))


def _decoder(columns: list[str], batch_rows: int):
    # Nested, so that it travels to the executors by value.
    def decode(batches):
        import datetime as dt
        import io
        import re
        import zipfile
        from xml.etree import ElementTree as ET

        import pandas as pd

        def local(tag):
            return tag.rsplit("}", 1)[-1]

        def joined_text(node):
            # Runs of one string; phonetic hints (rPh) are not part of it.
            parts = []
            for child in node:
                if local(child.tag) == "t":
                    parts.append(child.text or "")
                elif local(child.tag) == "r":
                    parts.extend(t.text or "" for t in child if local(t.tag) == "t")
            return "".join(parts)

        def shared_strings(book):
            if "xl/sharedStrings.xml" not in book.namelist():
                return []
            root = ET.fromstring(book.read("xl/sharedStrings.xml"))
            return [joined_text(item) for item in root if local(item.tag) == "si"]

        def date_styles(book):
            """Positions of the cell styles whose number format shows a date."""
            if "xl/styles.xml" not in book.namelist():
                return set()
            root = ET.fromstring(book.read("xl/styles.xml"))
            custom = {
                int(node.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", node.get("formatCode", ""))
                for node in root.iter() if local(node.tag) == "numFmt"
            }
            found = set()
            for group in root:
                if local(group.tag) != "cellXfs":
                    continue
                for position, style in enumerate(group):
                    number = int(style.get("numFmtId", 0))
                    if 14 <= number <= 22 or re.search("[ymdYMD]", custom.get(number, "")):
                        found.add(position)
            return found

        def first_sheet(book):
            workbook = ET.fromstring(book.read("xl/workbook.xml"))
            sheet = next(node for node in workbook.iter() if local(node.tag) == "sheet")
            link = next(value for key, value in sheet.attrib.items() if local(key) == "id")
            since_1904 = any(
                local(node.tag) == "workbookPr" and node.get("date1904") in ("1", "true")
                for node in workbook.iter()
            )
            links = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
            target = next(node.get("Target") for node in links if node.get("Id") == link)
            name = target.lstrip("/") if target.startswith("/") else "xl/" + target
            return name, dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 30)

        def number_text(raw):
            value = float(raw)
            return str(int(value)) if value.is_integer() else repr(value)

        def cell_text(cell, strings, dates, origin):
            kind = cell.get("t", "n")
            if kind == "inlineStr":
                return next((joined_text(node) for node in cell if local(node.tag) == "is"), None)
            raw = next((node.text for node in cell if local(node.tag) == "v"), None)
            if raw is None or kind == "e":
                return None
            if kind == "s":
                return strings[int(raw)]
            if kind == "n":
                if int(cell.get("s", -1)) in dates:
                    moment = origin + dt.timedelta(days=float(raw))
                    whole_day = moment.time() == dt.time(0)
                    return moment.date().isoformat() if whole_day else moment.isoformat(" ")
                return number_text(raw)
            return raw

        def column_number(reference, after):
            letters = re.match("[A-Z]*", reference or "").group()
            if not letters:
                return after + 1
            number = 0
            for letter in letters:
                number = number * 26 + ord(letter) - 64
            return number - 1

        def sheet_rows(book):
            strings, dates = shared_strings(book), date_styles(book)
            name, origin = first_sheet(book)
            header, all_rows = None, None
            with book.open(name) as sheet:
                for moment, node in ET.iterparse(sheet, events=("start", "end")):
                    tag = local(node.tag)
                    if moment == "start":
                        all_rows = node if tag == "sheetData" else all_rows
                        continue
                    if tag != "row":
                        continue
                    cells, position = {}, -1
                    for cell in node:
                        position = column_number(cell.get("r"), position)
                        cells[position] = cell_text(cell, strings, dates, origin)
                    all_rows.clear()  # a row that has been read is let go
                    if header is None:
                        header = {title: at for at, title in cells.items() if title}
                    elif any(value is not None for value in cells.values()):
                        yield tuple(cells.get(header.get(column, -1)) for column in columns)

        for batch in batches:
            for content in batch["content"]:
                ready = []
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    for row in sheet_rows(book):
                        ready.append(row)
                        if len(ready) == batch_rows:
                            yield pd.DataFrame(ready, columns=columns, dtype=object)
                            ready = []
                if ready:
                    yield pd.DataFrame(ready, columns=columns, dtype=object)

    return decode
