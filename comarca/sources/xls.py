"""Binary workbooks (.xls): the compound file's streams, and the cell records of the workbook's own stream.

A file is read whole in the task that holds it (65,536 rows a sheet at most). Sector chains and strings that run on over
records are followed; chains that leave the file or run in circles, records that are cut off, workbooks that are encrypted or
of before 1997 are errors, which the caller turns into the file's status.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping, Sequence

# Fixed values of the format.
MAGIC = bytes.fromhex("D0CF11E0A1B11AE1")
END, FREE, FAT_SECTOR, LAST_SECTOR = 0xFFFFFFFE, 0xFFFFFFFF, 0xFFFFFFFD, 0xFFFFFFFA
BOF, EOF, SHEET, SST, CONTINUE, FILEPASS = 0x809, 0x0A, 0x85, 0xFC, 0x3C, 0x2F
NUMBER, RK, MULRK, LABEL_SST, LABEL, FORMULA, STRING, BOOL_ERROR = 0x203, 0x27E, 0xBD, 0xFD, 0x204, 0x06, 0x207, 0x205
VERSION_8, MINI_LIMIT, SECTOR, MINI_SECTOR, MOST_RECORD = 0x600, 4096, 512, 64, 8224
ERRORS = {0x00: "#NULL!", 0x07: "#DIV/0!", 0x0F: "#VALUE!", 0x17: "#REF!", 0x1D: "#NAME?", 0x24: "#NUM!", 0x2A: "#N/A"}


def workbook_stream(raw: bytes) -> bytes:
    """The stream named Workbook of a compound file."""
    if raw[:8] != MAGIC:
        raise ValueError("no compound file")
    n_fat, first_entry, limit, first_mini, n_mini, first_more, n_more = _header(raw)
    shift, mini_shift = struct.unpack_from("<HH", raw, 30)
    size, ints = 1 << shift, (1 << shift) // 4

    def sector(k: int) -> bytes:
        out = raw[(k + 1) << shift : (k + 2) << shift]
        if not out:
            raise ValueError(f"sector {k} is beyond the end of the file")
        return out

    table = list(struct.unpack_from("<109I", raw, 76))
    more = first_more
    for _ in range(n_more):
        found = struct.unpack(f"<{ints}I", sector(more))
        table += found[:-1]
        more = found[-1]
    fat: list[int] = []
    for k in table[:n_fat]:
        fat += struct.unpack(f"<{ints}I", sector(k))

    def chain(first: int, links: Sequence[int]) -> Iterator[int]:
        seen = 0
        while first < LAST_SECTOR:
            if first >= len(links) or seen > len(links):
                raise ValueError("a chain of sectors leaves the file")
            yield first
            first, seen = links[first], seen + 1

    read = lambda first: b"".join(map(sector, chain(first, fat)))
    entries = read(first_entry)
    root = book = None
    for at in range(0, len(entries) - 127, 128):
        length, kind = struct.unpack_from("<HB", entries, at + 64)
        name = entries[at : at + max(0, length - 2)].decode("utf-16-le", "replace")
        first, bytes_ = struct.unpack_from("<II", entries, at + 116)
        if kind == 5:
            root = first
        elif kind == 2 and name in ("Workbook", "Book"):
            book = (name, first, bytes_)
    if book is None:
        raise ValueError("no workbook in the compound file")
    if book[0] == "Book":
        raise ValueError("a workbook of before 1997")
    _, first, bytes_ = book
    if bytes_ >= limit:
        out = read(first)
    else:
        mini = read(root) if root is not None else b""
        links = [x for k in chain(first_mini, fat) for x in struct.unpack(f"<{ints}I", sector(k))] if n_mini else []
        out = b"".join(mini[k << mini_shift : (k + 1) << mini_shift] for k in chain(first, links))
    if len(out) < bytes_:
        raise ValueError("the workbook is cut off")
    return out[:bytes_]


def _header(raw: bytes) -> tuple[int, ...]:
    """FAT sectors, first directory sector, mini limit, first mini FAT sector and their number, first further FAT list and their number."""
    if len(raw) < SECTOR:
        raise ValueError("the file is cut off")
    n_fat, first_entry = struct.unpack_from("<II", raw, 44)
    limit, first_mini, n_mini, first_more, n_more = struct.unpack_from("<IIIII", raw, 56)
    return n_fat, first_entry, limit, first_mini, n_mini, first_more, n_more


def records(book: bytes, at: int = 0) -> Iterator[tuple[int, bytes]]:
    """(kind, payload) from a place on."""
    while at < len(book):
        if at + 4 > len(book):
            raise ValueError("a record is cut off")
        kind, size = struct.unpack_from("<HH", book, at)
        payload = book[at + 4 : at + 4 + size]
        if len(payload) < size:
            raise ValueError("a record is cut off")
        yield kind, payload
        at += 4 + size


class _Parts:
    """The payloads of a record and those that continue it, read as one."""

    def __init__(self, parts: list[bytes]):
        self.parts, self.k, self.at = parts, 0, 0

    def _open(self) -> None:
        while self.at >= len(self.parts[self.k]):
            self.k, self.at = self.k + 1, 0
            if self.k >= len(self.parts):
                raise ValueError("a string is cut off")

    def take(self, n: int) -> bytes:
        out = b""
        while n > 0:
            self._open()
            some = self.parts[self.k][self.at : self.at + n]
            out, n, self.at = out + some, n - len(some), self.at + len(some)
        return out

    def text(self) -> str:
        """A string with its header; where characters go on in the next payload, a byte there says their width anew."""
        n, flags = struct.unpack("<HB", self.take(3))
        runs = struct.unpack("<H", self.take(2))[0] if flags & 8 else 0
        extra = struct.unpack("<I", self.take(4))[0] if flags & 4 else 0
        out = []
        while n > 0:
            if self.at >= len(self.parts[self.k]):
                self._open()
                flags = self.take(1)[0]
            width = 2 if flags & 1 else 1
            some = min(n, (len(self.parts[self.k]) - self.at) // width)
            if some == 0:
                raise ValueError("a string is cut off")
            out.append(self.take(some * width).decode("utf-16-le" if width == 2 else "latin-1", "surrogatepass"))
            n -= some
        self.take(4 * runs + extra)
        return "".join(out)


def _number(value: float) -> str:
    """As a workbook of the newer format writes it."""
    return str(int(value)) if value == int(value) and abs(value) < 1e15 else repr(value) if value == value and abs(value) != float("inf") else "#NUM!"


def _packed(value: int) -> float:
    """A number in 30 bits: an integer, or a double's upper ones; a hundredth of it if the lowest bit is set."""
    whole = value - (1 << 32) if value & 0x80000000 else value
    out = float(whole >> 2) if value & 2 else struct.unpack("<d", struct.pack("<Q", (value & 0xFFFFFFFC) << 32))[0]
    return out / 100 if value & 1 else out


def _plain(payload: bytes) -> str:
    return _Parts([payload]).text()


def sheets(raw: bytes) -> Iterator[tuple[str, int, int, list[str | None]]]:
    """(sheet, its place in the workbook, row number from 0, cells) of each row that has a cell."""
    book = workbook_stream(raw)
    own: list[tuple[int, str]] = []
    shared: list[str] = []
    parts: list[bytes] | None = None
    first = True
    for kind, payload in records(book):
        if first:
            if kind != BOF or struct.unpack_from("<H", payload)[0] != VERSION_8:
                raise ValueError("a workbook of another version")
            first = False
        if kind == CONTINUE and parts is not None:
            parts.append(payload)
            continue
        if parts is not None:
            shared, parts = _strings(parts), None
        if kind == FILEPASS:
            raise ValueError("the workbook is encrypted")
        if kind == SHEET and payload[5] == 0:  # worksheets alone have cells
            width = "utf-16-le" if payload[7] & 1 else "latin-1"
            own.append((struct.unpack_from("<I", payload)[0], payload[8 : 8 + payload[6] * (1 + (payload[7] & 1))].decode(width)))
        elif kind == SST:
            parts = [payload]
        elif kind == EOF:
            break
    else:
        raise ValueError("the workbook is cut off")
    for k, (at, name) in enumerate(own):
        cells = _cells(book, at, shared)
        for row in sorted(cells):
            line = cells[row]
            yield name, k, row, [line.get(c) for c in range(max(line) + 1)]


def _strings(parts: list[bytes]) -> list[str]:
    reader = _Parts(parts)
    _, n = struct.unpack("<II", reader.take(8))
    return [reader.text() for _ in range(n)]


def _cells(book: bytes, at: int, shared: list[str]) -> dict[int, dict[int, str]]:
    """row -> column -> text of the sheet whose records begin at a place."""
    out: dict[int, dict[int, str]] = {}
    put = lambda row, column, text: out.setdefault(row, {}).__setitem__(column, text)
    waits, ended = None, False
    for kind, p in records(book, at):
        if kind == EOF:
            ended = True
            break
        if kind == STRING and waits:
            put(*waits, _plain(p))
            waits = None
        elif kind in (NUMBER, RK, LABEL_SST, LABEL, FORMULA, BOOL_ERROR):
            row, column = struct.unpack_from("<HH", p)
            if kind == NUMBER:
                put(row, column, _number(struct.unpack_from("<d", p, 6)[0]))
            elif kind == RK:
                put(row, column, _number(_packed(struct.unpack_from("<I", p, 6)[0])))
            elif kind == LABEL_SST:
                put(row, column, shared[struct.unpack_from("<I", p, 6)[0]])
            elif kind == LABEL:
                put(row, column, _plain(p[6:]))
            elif kind == BOOL_ERROR:
                put(row, column, ERRORS.get(p[6], "#N/A") if p[7] else str(p[6]))
            elif p[12:14] != b"\xff\xff":
                put(row, column, _number(struct.unpack_from("<d", p, 6)[0]))
            elif p[6] == 0:  # the value is a string, and follows
                waits = (row, column)
            elif p[6] in (1, 2):
                put(row, column, str(p[8]) if p[6] == 1 else ERRORS.get(p[8], "#N/A"))
        elif kind == MULRK:
            row, column = struct.unpack_from("<HH", p)
            for k in range((len(p) - 6) // 6):
                put(row, column + k, _number(_packed(struct.unpack_from("<I", p, 6 + 6 * k)[0])))
    if not ended:
        raise ValueError("a sheet is cut off")
    return out


# ---- Writing, so that tables can be handed to others as such workbooks --------------------------------------------


def _record(kind: int, payload: bytes) -> bytes:
    return struct.pack("<HH", kind, len(payload)) + payload


def _shared_strings(strings: list[str]) -> bytes:
    """The shared strings' record and those that continue it; strings may be split between characters."""
    parts, own = [], struct.pack("<II", len(strings), len(strings))
    for s in strings:
        wide = any(ord(c) > 255 for c in s)
        raw = s.encode("utf-16-le" if wide else "latin-1")
        if len(own) + 3 + 2 > MOST_RECORD:
            parts.append(own)
            own = b""
        own += struct.pack("<HB", len(raw) // (1 + wide), wide)
        while raw:
            room = MOST_RECORD - len(own)
            room -= room % 2
            own, raw = own + raw[:room], raw[room:]
            if raw:
                parts.append(own)
                own = bytes([wide])
    parts.append(own)
    return b"".join(_record(SST if k == 0 else CONTINUE, p) for k, p in enumerate(parts))


def _sheet(rows: Mapping[int, Sequence[str | float | int | None]], number_of: dict[str, int]) -> bytes:
    out = [_record(BOF, struct.pack("<HHHHII", VERSION_8, 0x10, 0, 0, 0, 0))]
    for row, cells in sorted(rows.items()):
        for column, v in enumerate(cells):
            if isinstance(v, str):
                out.append(_record(LABEL_SST, struct.pack("<HHHI", row, column, 0, number_of[v])))
            elif isinstance(v, int) and -(1 << 29) <= v < 1 << 29:
                out.append(_record(RK, struct.pack("<HHHI", row, column, 0, (v << 2 | 2) & 0xFFFFFFFF)))
            elif v is not None:
                out.append(_record(NUMBER, struct.pack("<HHHd", row, column, 0, v)))
    return b"".join([*out, _record(EOF, b"")])


def written(sheets_: Mapping[str, Mapping[int, Sequence[str | float | int | None]]]) -> bytes:
    """A workbook of these sheets (name -> row number -> cells), in their order."""
    strings = list(dict.fromkeys(v for rows in sheets_.values() for cells in rows.values() for v in cells if isinstance(v, str)))
    number_of = {s: k for k, s in enumerate(strings)}
    bodies = [_sheet(rows, number_of) for rows in sheets_.values()]
    head = _record(BOF, struct.pack("<HHHHII", VERSION_8, 0x05, 0, 0, 0, 0))
    names = [n.encode("utf-16-le") for n in sheets_]
    strings_raw, end = _shared_strings(strings), _record(EOF, b"")
    at = len(head) + sum(4 + 8 + len(n) for n in names) + len(strings_raw) + len(end)
    bounds = []
    for name, body in zip(names, bodies, strict=True):
        bounds.append(_record(SHEET, struct.pack("<IBBBB", at, 0, 0, len(name) // 2, 1) + name))
        at += len(body)
    return _compound(b"".join([head, *bounds, strings_raw, end, *bodies]))


def _compound(book: bytes) -> bytes:
    """A compound file with one stream; a short one lies in the mini stream."""
    short = len(book) < MINI_LIMIT
    padded = lambda raw, n: raw + bytes(-len(raw) % n)
    body = padded(padded(book, MINI_SECTOR) if short else book, SECTOR)
    n_body, n_mini = len(body) // SECTOR, (-(-len(book) // MINI_SECTOR) if short else 0)
    mini_fat = padded(b"".join(struct.pack("<I", k + 1 if k + 1 < n_mini else END) for k in range(n_mini)), SECTOR) if short else b""
    mini_fat = mini_fat if not short else mini_fat[: 4 * n_mini] + b"\xff" * (len(mini_fat) - 4 * n_mini)
    n_mini_fat = len(mini_fat) // SECTOR
    n_fat = 1
    while n_fat * 128 < n_fat + 1 + n_mini_fat + n_body:
        n_fat += 1
    if n_fat > 109:
        raise ValueError("a workbook of over 7 MB")
    chained = lambda first, n: [first + k + 1 for k in range(n - 1)] + [END]
    first_body = n_fat + 1 + n_mini_fat
    fat = [FAT_SECTOR] * n_fat + [END] + (chained(n_fat + 1, n_mini_fat) if n_mini_fat else []) + chained(first_body, n_body)
    fat += [FREE] * (n_fat * 128 - len(fat))

    def entry(name: str, kind: int, child: int, first: int, size: int) -> bytes:
        raw = name.encode("utf-16-le")
        return raw.ljust(64, b"\0") + struct.pack("<HBBIII16xI16xIII", len(raw) + 2 if raw else 0, kind, 1, FREE, FREE, child, 0, first, size, 0)

    root = entry("Root Entry", 5, 1, first_body if short else END, n_mini * MINI_SECTOR)
    own = entry("Workbook", 2, FREE, 0 if short else first_body, len(book))
    directory = padded(root + own, SECTOR)
    header = MAGIC + bytes(16) + struct.pack("<HHHHH6xIIIIIIIII", 0x3E, 3, 0xFFFE, 9, 6, 0, n_fat, n_fat, 0, MINI_LIMIT, n_fat + 1 if n_mini_fat else END, n_mini_fat, END, 0)
    header += b"".join(struct.pack("<I", k if k < n_fat else FREE) for k in range(109))
    return header + struct.pack(f"<{len(fat)}I", *fat) + directory + mini_fat + body
