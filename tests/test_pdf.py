"""PDF files made here, plain and packed, against the text that was put in."""

import zlib

import pytest

from docloom.sources import files
from docloom.sources.pdf import pdf_to_xhtml

CMAP = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0001> <0416> endbfchar 1 beginbfrange <0010> <0012> <0061> endbfrange"
INFO = b"<< /Title (A \\(b\\) title) /Author <FEFF00C4> /CreationDate (D:20200514212219Z) >>"
ONE = b"BT /F1 12 Tf 72 720 Td (First line of text) Tj 0 -14 Td (goes on & ends.) Tj 0 -40 Td (Second \\(paragraph\\)) Tj T* [(Wo) -20 (rd) -300 (two)] TJ ET"
TWO = b"BT /F2 12 Tf 72 700 Td <00010010> Tj <00110012> Tj ET BT /F1 9 Tf 1 0 0 1 72 650 Tm (caf\\351) Tj ET"


def stream(data: bytes, packed: bool, more: bytes = b"") -> bytes:
    body = zlib.compress(data) if packed else data
    return b"<< /Length %d %s%s >>\nstream\n%s\nendstream" % (len(body), more, b"/Filter /FlateDecode" if packed else b"", body)


def pdf(pages: list[bytes], packed: bool = False, in_stream: bool = False) -> bytes:
    objects = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>", 4: INFO,
        5: b"<< /Type /Font /Subtype /Type0 /ToUnicode 6 0 R >>", 6: stream(CMAP, packed),
    }
    for k, c in enumerate(pages):
        objects[10 + 2 * k] = stream(c, packed)
        objects[11 + 2 * k] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (10 + 2 * k)
    kids = b" ".join(b"%d 0 R" % (11 + 2 * k) for k in range(len(pages)))
    objects[2] = b"<< /Type /Pages /Count %d /Kids [%s] /Resources << /Font << /F1 3 0 R /F2 5 0 R >> >> >>" % (len(pages), kids)
    if in_stream:  # everything that is no stream itself goes into an object stream
        own = {k: v for k, v in objects.items() if b"stream" not in v}
        places, data = [], b""
        for k, v in own.items():
            places += [k, len(data)]
            data += v + b" "
            del objects[k]
        head = b" ".join(b"%d" % x for x in places) + b" "
        objects[90] = stream(head + data, True, b"/Type /ObjStm /N %d /First %d " % (len(own), len(head)))
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % kv for kv in objects.items()) + b"\ntrailer << /Root 1 0 R /Info 4 0 R >>\n%%EOF"


@pytest.mark.parametrize("packed,in_stream", [(False, False), (True, False), (True, True)])
def test_text_of_pages(packed, in_stream):
    xhtml, meta = pdf_to_xhtml(pdf([ONE, TWO], packed, in_stream))
    assert xhtml == (
        '<body><div class="page"><p>First line of text goes on &amp; ends.</p><p>Second (paragraph) Word two</p></div>'
        '<div class="page"><p>Жabc café</p></div></body>'
    )
    assert meta == {"title": "A (b) title", "creator": "Ä", "created": "2020-05-14T21:22:19", "word_count": "14"}
    assert pdf_to_xhtml(pdf([]))[0] == "<body></body>"


def test_files_that_are_none(spark, tmp_path):
    for bad in (b"", b"%PDF", b"text", pdf([ONE]).replace(b"/Info", b"/Encrypt 9 0 R /Info")):
        with pytest.raises(ValueError):
            pdf_to_xhtml(bad)
    (tmp_path / "My paper.PDF").write_bytes(pdf([ONE], True))
    (tmp_path / "bad.pdf").write_bytes(b"%PDF")
    rows = {r.path[-6:]: r for r in files.office_documents(files.list_files(spark, str(tmp_path)), now="n").collect()}
    paper = next(r for r in rows.values() if not r.error)
    assert paper.doc_type == "PDF" and paper.record_id == "A (b) title" and paper.word_count == 12 and paper.author == "Ä" and paper.last_mod_date == "n"
    assert sorted(bool(r.error) for r in rows.values()) == [False, True]
