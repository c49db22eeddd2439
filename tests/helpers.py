"""Small helpers for fixtures."""

import zipfile


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


class Rows(list):
    """Rows that equal any list of the same rows, in whatever order."""

    def __eq__(self, other):
        return sorted(map(repr, self)) == sorted(map(repr, other))


def collected(df, *columns):
    """Rows as tuples, in a fixed order."""
    chosen = df.select(*columns) if columns else df
    return Rows(sorted((tuple(row) for row in chosen.collect()), key=repr))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def write_workbook(path, rows, date_columns=()):
    """A minimal workbook: text as shared strings, numbers as numbers, given columns as date serials."""
    strings, sheet_rows = [], []

    def letter(at):
        return chr(ord("A") + at)

    for number, row in enumerate(rows, start=1):
        cells = []
        for at, value in enumerate(row):
            where = f'r="{letter(at)}{number}"'
            if value is None:
                continue
            if isinstance(value, str):
                strings.append(value)
                cells.append(f'<c {where} t="s"><v>{len(strings) - 1}</v></c>')
            elif at in date_columns:
                cells.append(f'<c {where} s="1"><v>{value}</v></c>')
            else:
                cells.append(f"<c {where}><v>{value}</v></c>")
        sheet_rows.append(f'<row r="{number}">{"".join(cells)}</row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    links = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    shared = "".join(
        f"<si><r><t>{s[:2]}</t></r><r><t>{s[2:]}</t></r></si>" if i % 2 else f"<si><t>{s}</t></si>"
        for i, s in enumerate(strings)
    )
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {main} {links}><sheets><sheet name="s" sheetId="1" r:id="rId7"/></sheets></workbook>')
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId7" Type="t" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        book.writestr("xl/sharedStrings.xml", f"<sst {main}>{shared}</sst>")
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData>{"".join(sheet_rows)}</sheetData></worksheet>')
