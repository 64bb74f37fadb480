"""Local files in order, settings files, and writing results."""

from __future__ import annotations

import re
import zipfile
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curul.functions.calendar import MONTHS
from curul.functions.text import fold


def month_of_name(name: Column) -> Column:
    """The first day of the month that a file name says as "mes-aaaa"; null where it says none."""
    t = fold(name)
    p = "(" + "|".join(MONTHS) + r")[-_ ]?(\d{4})"
    m = F.array_position(F.array(*[F.lit(x) for x in MONTHS]), F.regexp_extract(t, p, 1))
    return F.when(m > 0, F.try_to_date(F.concat_ws("-", F.regexp_extract(t, p, 2), m), "y-M"))


def listed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, month) of the files under a path; order by month, those without one last, then by path."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length")
    return f.withColumn("month", month_of_name(F.element_at(F.split("path", "/"), -1)))


def read_settings(data: bytes) -> dict[str, str]:
    """KEY=VALUE lines of a settings file in UTF-8 or UTF-16, with or without a byte order mark; # begins a comment."""
    text = data.decode("utf-16") if data[:2] in (b"\xff\xfe", b"\xfe\xff") else data.decode("utf-8-sig")
    pairs = (line.split("=", 1) for line in text.splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {k.strip(): v.strip().strip("\"'") for k, v in pairs}


def write_records(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """JSON lines, replaced as a whole by the committer; with ``by`` one folder for each value."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).json(path)


def _cell(v: object) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool) or not isinstance(v, int | float):
        t = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(v))
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(t)}</t></is></c>'
    return f"<c><v>{v}</v></c>"


def write_workbook(path: str, sheets: dict[str, DataFrame], most_rows: int = 1_048_575) -> None:
    """A spreadsheet file of values, one sheet a frame, rows streamed through the driver; more rows than a sheet holds
    raise. Names are cut to 31 characters and must differ."""
    names = [re.sub(r"[\[\]:*?/\\]", " ", n)[:31] or "Sin tipo" for n in sheets]
    if len(set(names)) < len(names):
        raise ValueError("sheet names must differ")
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        tabs = "".join(f'<sheet name={quoteattr(n)} sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{tabs}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for k, df in enumerate(sheets.values(), 1):
            with z.open(f"xl/worksheets/sheet{k}.xml", "w") as f:
                f.write(f'<?xml version="1.0"?><worksheet xmlns="{main}"><sheetData>'.encode())
                f.write(("<row>" + "".join(map(_cell, df.columns)) + "</row>").encode())
                for n, row in enumerate(df.toLocalIterator(prefetchPartitions=False)):
                    if n >= most_rows:
                        raise ValueError(f"over {most_rows} rows in a sheet")
                    f.write(("<row>" + "".join(map(_cell, row)) + "</row>").encode())
                f.write(b"</sheetData></worksheet>")
