"""Write minimal .xlsx workbooks for reader tests (standard library only)."""

import datetime as dt
import zipfile
from xml.sax.saxutils import escape


def col_letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def write(path, rows, sheet="sheet1", start_row=1, start_col=1, inline=False):
    """``rows`` is a list of lists; None = empty cell; numbers stay numeric."""
    strings, index = [], {}
    xml_rows = []
    for i, row in enumerate(rows):
        r = start_row + i
        cells = []
        for j, v in enumerate(row):
            if v is None:
                continue
            ref = f"{col_letters(start_col + j)}{r}"
            if isinstance(v, bool):
                cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
            elif isinstance(v, dt.datetime):  # style 1 shows a date
                serial = (v - dt.datetime(1899, 12, 30)).total_seconds() / 86400
                cells.append(f'<c r="{ref}" s="1"><v>{serial!r}</v></c>')
            elif isinstance(v, (int, float)):
                cells.append(f'<c r="{ref}"><v>{v!r}</v></c>')
            elif inline:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>')
            else:
                if v not in index:
                    index[v] = len(strings)
                    strings.append(v)
                cells.append(f'<c r="{ref}" t="s"><v>{index[v]}</v></c>')
        xml_rows.append(f'<row r="{r}">{"".join(cells)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0"?><workbook {ns} {rns}><sheets>'
                   f'<sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml",
                   f'<?xml version="1.0"?><worksheet {ns}><sheetData>{"".join(xml_rows)}</sheetData></worksheet>')
        z.writestr("xl/styles.xml",
                   f'<?xml version="1.0"?><styleSheet {ns}><numFmts><numFmt numFmtId="164" '
                   'formatCode="yyyy&quot; d &quot;mm"/></numFmts>'
                   '<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>')
        sst = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
        z.writestr("xl/sharedStrings.xml", f'<?xml version="1.0"?><sst {ns}>{sst}</sst>')
