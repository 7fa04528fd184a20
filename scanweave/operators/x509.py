"""The few certificate fields that no Spark expression can take out of DER bytes."""

from __future__ import annotations

import re
from datetime import datetime
from functools import lru_cache

EPOCH = datetime(1970, 1, 1)

# DER tags.
BOOLEAN, INTEGER, BIT_STRING, OCTET_STRING, OID = 0x01, 0x02, 0x03, 0x04, 0x06
UTF8, NUMERIC, PRINTABLE, T61, IA5, BMP = 0x0C, 0x12, 0x13, 0x14, 0x16, 0x1E
UTC_TIME, GENERALIZED_TIME, SEQUENCE, SET = 0x17, 0x18, 0x30, 0x31
VERSION, EXTENSIONS = 0xA0, 0xA3
SAN_EMAIL, SAN_DNS, SAN_URI, SAN_IP = 0x81, 0x82, 0x86, 0x87

# Object identifiers (DER content) of the two extensions in use.
ALT_NAMES = bytes.fromhex("551d11")
CONSTRAINTS = bytes.fromhex("551d13")

# Name attributes with a label of their own, in the order they are printed.
LABELS = {
    "2.5.4.5": "SERIALNUMBER",
    "2.5.4.3": "CN",
    "2.5.4.17": "POSTALCODE",
    "2.5.4.9": "STREET",
    "2.5.4.8": "ST",
    "2.5.4.7": "L",
    "2.5.4.11": "OU",
    "2.5.4.10": "O",
    "2.5.4.6": "C",
}
# Of these, only the last value of a name is printed.
SINGLE = ("2.5.4.3", "2.5.4.5")

_PRINTABLE = re.compile(r"[A-Za-z0-9 '()+,\-./:=?*&]*\Z")
_NUMERIC = re.compile(r"[0-9 ]*\Z")
_TIME = re.compile(r"(\d{10})(\d\d)?(Z|[+-]\d{4})\Z", re.ASCII)


class Malformed(ValueError):
    pass


class Reader:
    """Forward reader over one DER value."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def more(self) -> bool:
        return self.at < len(self.data)

    def peek(self) -> int:
        return self.data[self.at] if self.more() else -1

    def raw(self, tag: int | None = None) -> tuple[int, bytes, bytes]:
        """Next element as tag, content and whole encoding."""
        data, start = self.data, self.at
        if start + 2 > len(data):
            raise Malformed("truncated")
        found, size, body = data[start], data[start + 1], start + 2
        if found & 0x1F == 0x1F or (tag is not None and found != tag):
            raise Malformed("unexpected tag")
        if size >= 0x80:
            count = size & 0x7F
            size = int.from_bytes(data[body : body + count], "big")
            body += count
            if not 1 <= count <= 4 or size < 0x80 or size < 1 << 8 * (count - 1):
                raise Malformed("length")
        end = body + size
        if end > len(data):
            raise Malformed("truncated")
        self.at = end
        return found, data[body:end], data[start:end]

    def take(self, tag: int) -> bytes:
        return self.raw(tag)[1]

    def inside(self, tag: int) -> Reader:
        return Reader(self.take(tag))

    def end(self) -> None:
        if self.more():
            raise Malformed("trailing data")


def _boolean(content: bytes) -> bool:
    if content not in (b"\x00", b"\xff"):
        raise Malformed("boolean")
    return content == b"\xff"


@lru_cache(maxsize=4096)
def _oid(content: bytes) -> str:
    arcs, value = [], 0
    for i, byte in enumerate(content):
        if byte == 0x80 and value == 0:
            raise Malformed("object identifier")
        value = value << 7 | byte & 0x7F
        if byte < 0x80:
            arcs.append(value)
            value = 0
        elif i == len(content) - 1:
            raise Malformed("object identifier")
    if not arcs:
        raise Malformed("object identifier")
    top = min(arcs[0] // 40, 2)
    return ".".join(map(str, [top, arcs[0] - 40 * top, *arcs[1:]]))


def _text(tag: int, content: bytes) -> str:
    try:
        if tag == UTF8:
            return content.decode("utf-8")
        if tag == T61:
            return content.decode("latin-1")
        if tag == BMP:
            return content.decode("utf-16-be").rstrip("\0")
        text = content.decode("ascii")
    except UnicodeDecodeError as error:
        raise Malformed("string") from error
    allowed = {PRINTABLE: _PRINTABLE, NUMERIC: _NUMERIC}.get(tag)
    if tag != IA5 and (allowed is None or not allowed.match(text)):
        raise Malformed("string")
    return text


def arranged(pairs: list[tuple[str, str]]) -> list[dict]:
    """Attributes in the order they are printed, each with the sign before it:
    labelled ones grouped by kind, then the others in reverse."""
    out = []
    for kind, label in LABELS.items():
        texts = [text for k, text in pairs if k == kind]
        if kind in SINGLE:
            texts = [text for text in texts[-1:] if text]
        out += [{"sep": "+" if i else ",", "label": label, "text": t} for i, t in enumerate(texts)]
    others = [{"sep": ",", "label": k, "text": t} for k, t in pairs if k not in LABELS]
    return out + others[::-1]


@lru_cache(maxsize=4096)
def _name(content: bytes) -> list[dict]:
    """Issuers repeat, so the last few thousand names are kept."""
    reader, pairs = Reader(content), []
    while reader.more():
        group = reader.inside(SET)
        while group.more():
            pair = group.inside(SEQUENCE)
            kind = _oid(pair.take(OID))
            tag, value, _ = pair.raw()
            pairs.append((kind, _text(tag, value)))
    return arranged(pairs)


def _micros(reader: Reader) -> int:
    tag, content, _ = reader.raw()
    text = content.decode("latin-1")
    if tag == UTC_TIME:
        text = ("19" if text[:2] >= "50" else "20") + text
    elif tag != GENERALIZED_TIME:
        raise Malformed("time")
    match = _TIME.match(text[2:])
    if not match or not text[:2].isdigit() or (tag == GENERALIZED_TIME and not match[2]):
        raise Malformed("time")
    digits, seconds, zone = match.groups()
    year = int(text[:2] + digits[:2])
    month, day, hour, minute = (int(digits[i : i + 2]) for i in (2, 4, 6, 8))
    # Year 0 is a valid one here but not in Python: count from 400 years later.
    shift = 400 if year == 0 else 0
    moment = datetime(year + shift, month, day, hour, minute, int(seconds or 0)) - EPOCH
    days = moment.days - (146097 if shift else 0)
    offset = 0 if zone == "Z" else int(zone[0] + "1") * (int(zone[1:3]) * 60 + int(zone[3:])) * 60
    return (days * 86400 + moment.seconds - offset) * 10**6


def _dns_names(value: bytes) -> list[str]:
    outer = Reader(value)
    names = outer.inside(SEQUENCE)
    outer.end()
    found = []
    while names.more():
        tag, content, _ = names.raw()
        if tag in (SAN_EMAIL, SAN_DNS, SAN_URI) and not content.isascii():
            raise Malformed("alternative name")
        if tag == SAN_IP and len(content) not in (4, 16):
            raise Malformed("alternative name")
        if tag == SAN_DNS:
            found.append(content.decode("ascii"))
    return found


def _is_ca(value: bytes) -> bool:
    outer = Reader(value)
    body = outer.inside(SEQUENCE)
    outer.end()
    ca = _boolean(body.take(BOOLEAN)) if body.peek() == BOOLEAN else False
    if body.peek() == INTEGER:
        body.take(INTEGER)
    return ca


def _extensions(reader: Reader) -> dict[bytes, bytes]:
    found: dict[bytes, bytes] = {}
    listed = reader.inside(SEQUENCE)
    while listed.more():
        one = listed.inside(SEQUENCE)
        kind = one.take(OID)
        if one.peek() == BOOLEAN:
            _boolean(one.take(BOOLEAN))
        if kind in found:
            raise Malformed("extension given twice")
        found[kind] = one.take(OCTET_STRING)
    return found


def fields(der: bytes) -> dict | None:
    """The fields of one certificate, None if it is not a well-formed one."""
    try:
        outer = Reader(der)
        cert = outer.inside(SEQUENCE)
        outer.end()
        body = cert.inside(SEQUENCE)
        version = 1
        if body.peek() == VERSION:
            version = 1 + int.from_bytes(body.inside(VERSION).take(INTEGER), "big", signed=True)
        if not 1 <= version <= 3:
            raise Malformed("version")
        body.take(INTEGER)
        body.take(SEQUENCE)
        issuer = _name(body.take(SEQUENCE))
        validity = body.inside(SEQUENCE)
        begin, end = _micros(validity), _micros(validity)
        subject = _name(body.take(SEQUENCE))
        key = body.raw(SEQUENCE)[2]
        extensions: dict[bytes, bytes] = {}
        if version > 1:
            while body.more() and body.peek() != EXTENSIONS:
                body.raw()
            if version == 3 and body.more():
                extensions = _extensions(body.inside(EXTENSIONS))
        cert.take(SEQUENCE)
        cert.take(BIT_STRING)
        names = _dns_names(extensions[ALT_NAMES]) if ALT_NAMES in extensions else []
        return {
            "subject": subject,
            "issuer": issuer,
            "notBefore": begin,
            "notAfter": end,
            "basicConstraints": CONSTRAINTS in extensions,
            "isCa": CONSTRAINTS in extensions and _is_ca(extensions[CONSTRAINTS]),
            "publicKey": key,
            "altNames": names or None,
        }
    except ValueError:
        return None
