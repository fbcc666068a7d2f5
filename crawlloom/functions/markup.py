"""Row helpers for the markup that built-in expressions cannot treat exactly.

Only the rows that :mod:`crawlloom.functions.html` singles out come here.
"""

from __future__ import annotations

import codecs
import re
import unicodedata
from html.entities import html5

# Tags around which text is broken or left out.
START_BREAK = ["ul", "ol", "dl", "tr"]
END_BREAK = ["p", "div", "li", "dd", "th", "td"] + [f"h{n}" for n in range(1, 10)]
NO_TEXT = ["script", "noscript", "style"]
# Fixed values (HTML standard): elements whose content is not markup; in the last
# two, character references still count.
RAW_TEXT = ["iframe", "noembed", "noframes", "noscript", "plaintext", "script", "style", "xmp"]
ESCAPABLE = ["textarea", "title"]

_TAG = re.compile(
    r"""
      <!--(?:-?>|.*?(?:--!?>|\Z))                 # comment
    | <(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)        # doctype and bogus comments
    | <(?P<close>/?)(?P<name>[a-zA-Z][^ \n\r\t\f/>]*)
      (?:[^>=]++|=[ \n\r\t\f]*+(?:"[^"]*+"|'[^']*+'|[^ \n\r\t\f>"'][^ \n\r\t\f>]*+|(?=>)))*+>
    | <[a-zA-Z/].*\Z                              # a tag the input ends in
    """,
    re.X | re.S,
)
_REFERENCE = re.compile(r"&(?:#[xX]([0-9a-fA-F]+);?|#([0-9]+);?|([a-zA-Z0-9]+;?))")
_C1 = {n: bytes([n]).decode("cp1252", "replace") for n in range(0x80, 0xA0)}


def _reference(m: re.Match) -> str:
    hexadecimal, decimal, name = m.groups()
    if name is None:
        n = int(hexadecimal, 16) if hexadecimal else int(decimal)
        if n in _C1:
            return _C1[n] if _C1[n] != "�" else chr(n)
        if n == 0 or 0xD800 <= n <= 0xDFFF or n > 0x10FFFF:
            return "�"
        return chr(n)
    if name in html5:
        return html5[name]
    # names that are also valid without a semicolon match by longest prefix
    for end in range(len(name) - 1, 1, -1):
        if name[:end] in html5:
            return html5[name[:end]] + name[end:]
    return m.group()


def unescape(text: str) -> str:
    return _REFERENCE.sub(_reference, text) if "&" in text else text


def _script_end(html: str, start: int) -> re.Match | None:
    """End tag of a script; one inside ``<!-- <script`` does not count."""
    pos = start
    while True:
        end = re.compile(r"</script(?=[ \n\r\t\f/>])", re.I).search(html, pos)
        if end is None:
            return None
        opened = html.rfind("<!--", start, end.start())
        if opened < 0 or html.find("-->", opened, end.start()) >= 0:
            return end
        if not re.search(r"<script[ \n\r\t\f/>]", html[opened : end.start()], re.I):
            return end
        pos = end.end()
        closed = html.find("-->", opened)
        if closed < 0 and re.compile(r"</script(?=[ \n\r\t\f/>])", re.I).search(html, pos) is None:
            return None


def _content_end(name: str, html: str, pos: int) -> re.Match | None:
    """End tag of an element whose content is not markup; None when it reaches to the end."""
    if name == "plaintext":
        return None
    if name == "script":
        return _script_end(html, pos)
    return re.compile(rf"</{name}(?=[ \n\r\t\f/>])", re.I).search(html, pos)


def strip_markup(html: str) -> str:
    """Text of a page: block tags become line breaks, other end tags a space."""
    out: list[str] = []
    last = ""

    def text(piece: str, raw: bool = False) -> None:
        if not piece or last in NO_TEXT or last == "":
            return
        piece = piece.replace("\r\n", "\n").replace("\r", "\n")
        out.append((piece if raw else unescape(piece)).replace("\n", " "))

    pos, size = 0, len(html)
    while pos < size:
        m = _TAG.search(html, pos)
        if m is None:
            text(html[pos:])
            break
        text(html[pos : m.start()])
        pos = m.end()
        name = m["name"] and m["name"].lower()
        if not name:
            continue
        if m["close"]:
            out.append("\n" if name in END_BREAK else " ")
            continue
        if html[pos - 2] == "/":
            if name == "br":
                out.append("\n")
        else:
            if name in START_BREAK:
                out.append("\n")
            last = name
        if name in RAW_TEXT or name in ESCAPABLE:
            end = _content_end(name, html, pos)
            stop = end.start() if end else size
            text(html[pos:stop], raw=name in RAW_TEXT)
            pos = stop
    return "".join(out)


def clean(html: str, markup: bool = True) -> str:
    """Markup removed, compatibility-normalised, references decoded once more."""
    text = strip_markup(html) if markup else html
    return unescape(unicodedata.normalize("NFKC", text))


# Fixed values (encoding standard): labels that browsers read as windows-1252.
_WESTERN = ["ascii", "us-ascii", "iso-8859-1", "iso8859-1", "latin1", "l1", "cp1252", "windows-1252"]
_ATTRIBUTE = re.compile(
    r"""[ \n\r\t\f/]*([^ \n\r\t\f/>=][^ \n\r\t\f/>=]*)"""
    r"""(?:[ \n\r\t\f]*=[ \n\r\t\f]*(?:"([^"]*)"|'([^']*)'|([^ \n\r\t\f>"'][^ \n\r\t\f>]*)))?"""
)
_IN_CONTENT = re.compile(r"""charset[ \n\r\t\f]*=[ \n\r\t\f]*(?:"([^"]*)"|'([^']*)'|([^ \n\r\t\f;"'][^ \n\r\t\f;]*))""", re.I)
#: Codecs of the standard library that are no charsets of pages.
_NO_CHARSETS = ["utf_7", "idna", "punycode", "unicode_escape", "raw_unicode_escape"]


def known_charset(label: str) -> str | None:
    """The codec of a charset label, None for a label that names none."""
    label = label.strip(" \n\r\t\f").lower()
    if label in _WESTERN:
        return "cp1252"
    try:
        codec = codecs.lookup(label)
    except (LookupError, ValueError):
        return None
    return codec.name if codec._is_text_encoding and codec.name.replace("-", "_") not in _NO_CHARSETS else None


def _meta_charset(tag: str) -> str | None:
    """What a meta tag declares: by ``charset``, or by ``content`` beside a content-type ``http-equiv``."""
    attributes: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag):
        name, *values = m.groups()
        value = next((v for v in values if v is not None), "")
        attributes.setdefault(name.lower(), unescape(value))
    if "charset" in attributes:
        return known_charset(attributes["charset"])
    inside = _IN_CONTENT.search(attributes.get("content", ""))
    if inside and attributes.get("http-equiv", "").lower() == "content-type":
        return known_charset(next(v for v in inside.groups() if v is not None))
    return None


def declared_charset(body: bytes) -> str | None:
    """Codec named by the first meta tag of a page that names one.

    Tags are walked as in ``strip_markup``: comments, the content of scripts and the
    like, attributes of other tags and prose declare nothing, wherever they stand.
    """
    if not re.search(rb"charset", body, re.I):
        return None
    page, pos = body.decode("latin-1"), 0
    while m := _TAG.search(page, pos):
        pos = m.end()
        name = m["name"] and m["name"].lower()
        if not name or m["close"]:
            continue
        if name == "meta":
            found = _meta_charset(page[m.end("name") : pos - 1])
            if found:
                return "utf-8" if found.startswith("utf-16") else found
        elif name in RAW_TEXT or name in ESCAPABLE:
            end = _content_end(name, page, pos)
            if end is None:
                return None
            pos = end.start()
    return None


def decode(body: bytes, charset: str | None) -> str:
    """Bytes as text by the charset of the header, else by what the page itself declares."""
    label = (charset or "").strip(" \"'").lower()
    if not label:
        for mark, name in ((codecs.BOM_UTF8, "utf-8"), (b"\xfe\xff", "utf-16-be"), (b"\xff\xfe", "utf-16-le")):
            if body.startswith(mark):
                return body[len(mark) :].decode(name, "replace")
        label = declared_charset(body) or ""
    if not label:
        try:
            return body.decode("utf-8")
        except UnicodeDecodeError:
            label = "windows-1252"
    return body.decode(known_charset(label) or "utf-8", "replace")
