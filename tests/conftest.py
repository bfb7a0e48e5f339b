import os
import sys
import zipfile
from io import BytesIO
from xml.sax.saxutils import escape

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronograde.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "chronograde-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def column_letters(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def workbook(rows: list[list], sheet: str = "MASTER") -> bytes:
    """Smallest workbook with one sheet; numbers as numbers, text as shared strings, None as no cell."""
    strings: list[str] = []
    lines = []
    for r, row in enumerate(rows):
        cells = []
        for c, value in enumerate(row):
            ref = f"{column_letters(c)}{r + 1}"
            if value is None:
                continue
            if isinstance(value, (int, float)):
                cells.append(f'<c r="{ref}"><v>{value}</v></c>')
            else:
                strings.append(value)
                cells.append(f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>')
        lines.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}">{"".join(f"<si><t xml:space=\"preserve\">{escape(s)}</t></si>" for s in strings)}</sst>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    out = BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, text in parts.items():
            book.writestr(zipfile.ZipInfo(name), text)
    return out.getvalue()


def rating_rows(entity: str = "Company A", **changes) -> list[list]:
    """A complete, valid grid. ``changes`` replace values by label; underscores stand for spaces."""
    values = {
        "Rated entity": [entity],
        "CorporateSector": ["Chemicals"],
        "Rating methodologies applied": ["Chemicals Rating Methodology", "General Corporate Rating Methodology"],
        "Industry risk": ["Capital Goods", "Media"],
        "Industry risk score": ["BBB", "A"],
        "Industry weight": [0.4, 0.6],
        "Segmentation criteria": ["Other"],
        "Reporting Currency/Units": ["EUR"],
        "Country of origin": ["Ireland"],
        "Accounting principles": ["IFRS"],
        "End of business year": ["December"],
        "Sector/company-specific factors (2)": [None],
        "Liquidity": ["+1 notch"],
    }
    for grade in ("Business risk profile", "(Blended) Industry risk profile", "Competitive Positioning", "Market share",
                  "Diversification", "Operating profitability", "Sector/company-specific factors (1)",
                  "Financial risk profile", "Leverage", "Interest cover", "Cash flow cover"):
        values[grade] = ["BB+"]
    metrics = changes.pop("metrics", {"Debt/EBITDA": [4.856, 5, "No data", 1234567.5], "Cover": [1, 2, 3, 4]})
    years = changes.pop("years", [2022, 2023, 2024, "2025E"])
    for label, value in changes.items():
        values[label.replace("_", " ")] = value if isinstance(value, list) else [value]
    rows = [[None, label, *vals] for label, vals in values.items()]
    rows.append([None, "[Scope Credit Metrics]", *years])
    rows += [[None, name, *vals, "Locked"] for name, vals in metrics.items()]
    return rows


def cells_of(grids: dict[int, list[list]]) -> list[tuple]:
    """Long cells of text grids."""
    return [
        (fid, r, c, None if v is None else str(v))
        for fid, rows in grids.items() for r, row in enumerate(rows) for c, v in enumerate(row) if v is not None
    ]
