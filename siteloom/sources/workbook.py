"""A workbook (Office Open XML) of display rows with thumbnails, written row by row without a spreadsheet library."""

from __future__ import annotations

import struct
from collections.abc import Iterable
from pathlib import Path
from xml.sax.saxutils import escape
from zipfile import ZIP_DEFLATED, ZipFile

HEADERS = ("Asset", "Site type", "Conf", "Located", "Cell equip", "Views", "Photo")
WIDTHS = (22, 12, 8, 14, 42, 8, 24)
ROW_HEIGHT, THUMB = 95, (160, 120)
#: Rows of a sheet of the format, the header being one.
SHEET_ROWS = 1_048_576
_EMU = 9525  # a pixel
_MAIN, _DOC = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG, _XDR, _A = "http://schemas.openxmlformats.org/package/2006", "http://schemas.openxmlformats.org/drawingml/2006/spreadsheetDrawing", "http://schemas.openxmlformats.org/drawingml/2006/main"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_STYLES = (
    f'{_HEAD}<styleSheet xmlns="{_MAIN}"><fonts count="2"><font><sz val="11"/><name val="Calibri"/></font><font><b/><color rgb="FFFFFFFF"/><sz val="11"/><name val="Calibri"/></font></fonts>'
    '<fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FF1F4E79"/></patternFill></fill></fills>'
    '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf xfId="0"/><xf xfId="0" fontId="1" fillId="2" applyFont="1" applyFill="1" applyAlignment="1">'
    '<alignment horizontal="center"/></xf></cellXfs></styleSheet>'
)


def jpeg_size(data: bytes) -> tuple[int, int] | None:
    """Width and height from a JPEG's frame header."""
    at = 2
    while data[:2] == b"\xff\xd8" and at + 9 < len(data) and data[at] == 0xFF:
        kind, length = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        at += 2 + length
    return None


def fitted(width: int, height: int, most: tuple[int, int] = THUMB) -> tuple[int, int]:
    """The size that an image is shown in: never enlarged."""
    scale = min(1.0, most[0] / width, most[1] / height)
    return max(1, round(width * scale)), max(1, round(height * scale))


def _cell(column: int, row: int, value, style: int = 0) -> str:
    if value is None:
        return ""
    at = f'r="{"ABCDEFG"[column]}{row}"' + f' s="{style}"' * bool(style)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c {at}><v>{value!r}</v></c>"
    return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def _relations(*rows: tuple[str, str, str]) -> str:
    return f'{_HEAD}<Relationships xmlns="{_PKG}/relationships">' + "".join(f'<Relationship Id="{i}" Type="{_DOC}/{kind}" Target="{to}"/>' for i, kind, to in rows) + "</Relationships>"


def _picture(n: int, row: int, size: tuple[int, int]) -> str:
    w, h = (x * _EMU for x in size)
    return (
        f"<xdr:oneCellAnchor><xdr:from><xdr:col>6</xdr:col><xdr:colOff>0</xdr:colOff><xdr:row>{row - 1}</xdr:row><xdr:rowOff>0</xdr:rowOff></xdr:from><xdr:ext cx=\"{w}\" cy=\"{h}\"/>"
        f'<xdr:pic><xdr:nvPicPr><xdr:cNvPr id="{n}" name="Image {n}"/><xdr:cNvPicPr/></xdr:nvPicPr><xdr:blipFill><a:blip r:embed="rId{n}"/><a:stretch><a:fillRect/></a:stretch></xdr:blipFill>'
        f'<xdr:spPr><a:xfrm><a:off x="0" y="0"/><a:ext cx="{w}" cy="{h}"/></a:xfrm><a:prstGeom prst="rect"/></xdr:spPr></xdr:pic><xdr:clientData/></xdr:oneCellAnchor>'
    )


def write(path: str, rows: Iterable[tuple], images: Path | None = None, sheet_rows: int = SHEET_ROWS) -> str:
    """Rows are (asset, site type, conf, located, cell equip, views, image); the image is a JPEG's path, under ``images`` if it is relative.

    A further sheet begins where one is full. If the file can't be overwritten, one with ``_updated`` in its name is written; the path is returned.
    """
    try:
        _write(path, rows, images, sheet_rows)
        return path
    except PermissionError:
        other = str(Path(path).with_stem(Path(path).stem + "_updated"))
        _write(other, rows, images, sheet_rows)
        return other


def _write(path: str, rows: Iterable[tuple], images: Path | None, sheet_rows: int) -> None:
    with ZipFile(path, "w", ZIP_DEFLATED) as z:
        it, sheets, media, more = iter(rows), 0, 0, True
        ahead = next(it, None)
        while more:
            sheets += 1
            pictures = []
            with z.open(f"xl/worksheets/sheet{sheets}.xml", "w", force_zip64=True) as out:
                put = lambda text: out.write(text.encode("utf-8"))  # noqa: B023, E731
                put(f'{_HEAD}<worksheet xmlns="{_MAIN}" xmlns:r="{_DOC}"><cols>' + "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(WIDTHS, 1)) + "</cols><sheetData>")
                put('<row r="1">' + "".join(_cell(i, 1, h, 1) for i, h in enumerate(HEADERS)) + "</row>")
                n = 1
                while ahead is not None and n < sheet_rows:
                    n += 1
                    put(f'<row r="{n}" ht="{ROW_HEIGHT}" customHeight="1">' + "".join(_cell(i, n, x) for i, x in enumerate(ahead[:6])) + "</row>")
                    if ahead[6]:
                        file = Path(ahead[6]) if images is None or Path(ahead[6]).is_absolute() else images / ahead[6]
                        if file.exists() and (size := jpeg_size(data := file.read_bytes())):
                            pictures.append((n, fitted(*size), data))
                    ahead = next(it, None)
                put("</sheetData>" + '<drawing r:id="rId1"/>' * bool(pictures) + "</worksheet>")
            if pictures:
                z.writestr(f"xl/worksheets/_rels/sheet{sheets}.xml.rels", _relations(("rId1", "drawing", f"../drawings/drawing{sheets}.xml")))
                drawn = "".join(_picture(k, row, size) for k, (row, size, _) in enumerate(pictures, 1))
                z.writestr(f"xl/drawings/drawing{sheets}.xml", f'{_HEAD}<xdr:wsDr xmlns:xdr="{_XDR}" xmlns:a="{_A}" xmlns:r="{_DOC}">{drawn}</xdr:wsDr>')
                z.writestr(f"xl/drawings/_rels/drawing{sheets}.xml.rels", _relations(*((f"rId{k}", "image", f"../media/image{media + k}.jpg") for k in range(1, len(pictures) + 1))))
                for k, (_, _, data) in enumerate(pictures, 1):
                    z.writestr(f"xl/media/image{media + k}.jpg", data)
                media += len(pictures)
            more = ahead is not None
        names = ["Results" if i == 1 else f"Results {i}" for i in range(1, sheets + 1)]
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><sheets>' + "".join(f'<sheet name="{x}" sheetId="{i}" r:id="rId{i}"/>' for i, x in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", _relations(*((f"rId{i}", "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, sheets + 1)), (f"rId{sheets + 1}", "styles", "styles.xml")))
        z.writestr("xl/styles.xml", _STYLES)
        z.writestr("_rels/.rels", _relations(("rId1", "officeDocument", "xl/workbook.xml")))
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, sheets + 1))
        kinds += "".join(f'<Override PartName="/{x}" ContentType="application/vnd.openxmlformats-officedocument.drawing+xml"/>' for x in z.namelist() if x.startswith("xl/drawings/drawing"))
        z.writestr(
            "[Content_Types].xml",
            f'{_HEAD}<Types xmlns="{_PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            '<Default Extension="jpg" ContentType="image/jpeg"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>',
        )
