"""Personal data: pattern spans, and spans from a linear-chain conditional
random field over word shapes.

The patterns find well-formed addresses and numbers.  The field gives each word
the tag "none", or "begin" or "inside" of a kind, from the shapes (letters,
digits, leading zeros, punctuation classes, line ends) of the word and its
neighbours and from the digits that stand before it in its run.  It is trained
from a table of marked lines (``training_lines``: lines written by hand and
lines made from formats by a fixed seed) and decoded by Viterbi over whole
batches of word runs in numpy.  A word without a digit or an at sign is never
personal data, so the chain splits exactly at such words and only the runs
between them are decoded.  A field span is added where it passes its kind's
check and touches no pattern span; pattern spans always stay.

Defined cases: null and empty texts have no spans; a null id passes through;
repeated rows are read one by one; an empty table gives an empty result; texts
are read whole; columns other than id and text are ignored.  Positions are code
points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, id_text, map_batches, rewrite_batches, texts

KINDS = ("email", "ip", "card", "phone")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CELLS = 1 << 16     # words of runs that are decoded at one time, or one longer run
CHUNK = re.compile(r"\S*@\S*")

# Marked lines written by hand: [kind|words] marks what is to be found.
EXAMPLES = """
write to [email|ana.b@mail.example.org] or call [phone|(555) 010-4477] today
reach me at [phone|555-013-2299] after six
his number is [phone|(212) 555-0143] and hers [phone|212-555-0188] as listed
tel. [phone|030 1234 5678] fax [phone|030 1234 5679]
call [phone|0044 20 7946 0958] or [phone|+44 20 7946 0958] now
the desk answers on [phone|+1 (743) 555-3824] every day
phone [phone|01 42 68 53 00] before noon
mobile [phone|0170 5551234] please
ring [phone|555.014.7788] twice
pay with [card|4111 1111 1111 1111] or [card|5500-0000-0000-0004] here
card [card|4111.1111.1111.1111] was charged
the card [card|340000000000009] has expired
charged to [card|4012888888881881] on file
host [ip|192.0.2.17] answered and [ip|198.51.100.4] did not
the server [ip|2001:db8:0:1:1:1:1:1] sent it to [ip|fe80::1ff:fe23:4567:890a] again
block [ip|203.0.113.9] at the gate
mail [email|jo_smith+x@dept.example.com] for help
contact [email|office@example.net] soon
send it to [email|m.k@localhost] inside
in 1998 there were 12 of 340 left
the price was 1,299.50 in 2021 and 980 before
version 2.0 of 3.11.4 came on 2023-05-17 at 10:45:30
chapter 4 has 120 pages and 35 figures
see section 3.2.1 and table 12-4 on page 1080
order 20394857 weighs 12.5 kg
it scored 3-1 and 21-19 in 2019-2020
about 1 000 000 people and 45 000 cars
the year 1984 and the years 1990-1995 passed
temperatures of -12.5 to +31 were seen
token 24be64439e3e49cf46b2d7c90f3602a3d0b907ff was revoked
key a1b2c3d4e5f6 and id 0x7f3a at 00:1a:2b:3c
isbn 978-3-16-148410-0 is out of print
on 12/05/2021 and 12.05.2021 it was 50% off
figure 7 shows 100-200 units for $25 each
@someone said so and @team agreed
at 5 pm room 101 on floor 3 has 20 seats
the score 1234567 and the sum 99 are wrong
items 11 12 13 14 15 16 follow
phones [phone|555-013-2299] [phone|555-013-2298] [phone|212-555-0188]
[phone|(555) 010-4477] [phone|(212) 555-0143] [phone|(743) 555-3824]
numbers [phone|030 1234 5678] [phone|030 1234 5679]
[phone|030 1234 5678] [phone|030 1234 5679] [phone|030 1234 5670]
[phone|01 42 68 53 00] [phone|01 42 68 53 01] [phone|01 42 68 53 02]
mobiles [phone|0170 5551234] [phone|0171 5559876] [phone|0172 5553412]
dial [phone|01 42 68 53 00] [phone|01 42 68 53 01]
local [phone|555-0132] [phone|555-0199] [phone|555-0111]
faxes [phone|555.014.7788] [phone|555.014.7789]
cards [card|4111.1111.1111.1111] [card|5500.0000.0000.0004]
both [card|4111 1111 1111 1111] [card|5500 0000 0000 0004]
[card|4111 1111 1111 1111] [card|5500 0000 0000 0004] [card|4111 1111 1111 1111]
hosts [ip|fe80::1ff:fe23:4567:890a] [ip|fe80::1ff:fe23:4567:890b] [ip|2001:db8:0:1:1:1:1:1] [ip|fe80::1]
[ip|fe80::1] [ip|fe80::2] [ip|fe80::3] [ip|2001:db8::7]
mail [email|m.k@localhost] [email|jo@desk] [email|a.b@host]
[phone|030 1234 5678]
555-0132
part 555-0132 is out of stock
1234567 7654321
pages 100-200 300-400
rows 1200 3400 5600 7800 9000
tracking 123 456 7890 12
parcel number 987 654 3210 98 is late
please ask for 555 123 4567 89 there
at 10:45:30 10:45:31 10:46:02 it rang
on 2023-05-17 2023-05-18 2024-01-02 it snowed
"""
_MARK = re.compile(r"\[(email|ip|card|phone)\|([^\]]*)\]")

# Formats of made items: n a digit from 1, d any digit, h one to four hex
# digits, w a lower-case name; other characters stand for themselves.
FORMATS = {
    "phone": ["(nnd) ndd-dddd", "nnd-ndd-dddd", "nnd.ndd.dddd", "nnd ndd dddd", "1-nnd-ndd-dddd", "+1 (nnd) ndd-dddd",
              "+nn dd dddd dddd", "+nn nd dd dd dd dd", "00nn nd dddd dddd", "0n dd dd dd dd", "1 nnd ndd dddd",
              "0nd dddd dddd", "0nnd ndd dddd", "0nnd ddddddd", "0nd-dddd-dddd", "(0nd) dddd dddd", "0nnnn dddddd"],
    "card": ["nddd dddd dddd dddd", "nddd-dddd-dddd-dddd", "nddd.dddd.dddd.dddd", "nddd dddddd ddddd", "nddd dddddd dddd", "nd00 0000 0000 000d",
             "nddddddddddddddd", "ndddddddddddddd", "nddddddddddddd"],
    "ip": ["nd.d.nd.1dd", "1dd.nd.d.nd", "h:h:h:h:h:h:h:h", "h::h", "h::n", "h:h:h::h", "h:h:h::h:h:h", "h::h:h:h:h", "::n", "fe80::h:h",
           "fe80::n", "nddd:0dbn:n::d", "0d0n:0dbn:0000:0000:h:h:h:h"],
    "email": ["w@w", "w.w@w", "w@wnd", "w@wdd", "w_w@w", "wn@w-n", "w@w.example", "w.w@w.example.org"],
}
LOCAL_FORMATS = ["ndd-dddd", "ndd.dddd"]     # phones only beside others of the kind
OTHER = ["nddd-0n-nd", "0n/nd/nddd", "nd.0n.nddd", "nd:dd", "nd:dd:dd", "n.d.nd", "n.nd", "n,ddd.dd", "$nd.dd", "n ddd ddd",
         "nd ddd", "nddd", "nddd nddd", "nddd nddd nddd nddd nddd", "97n-n-nd-dddddd-d", "ndd-ndd", "nd-nd", "nd", "n", "ndd",
         "ndddd", "nddddd", "ndddddd", "nddddddd", "ndddddddd", "#ndddd", "0xhh", "hh-hh-hh", "ndd ndd nddd nd",
         "nd 0d nd", "nd.dddddd, -n.dddddd", "ndd-nd-nddd", "ndddd-nddd", "nd%", "nd,nd", "000nd", "0n", "DEnd nddd 00dd 0ndd 0ndd dd",
         "nd nd nd nd nd", "nd nd nd nd nd nd", "nd:dd:nd:nd:nd:nd", "n-n", "n/n", "v n.n.n", "ndd.nd", "-nd.n", "@w", "ndst", "nddd/nd"]
PLAIN = "the on with of please use it for that sent and was we listed in as their new note number".split()


def luhn_last(digits: str) -> str:
    """The last digit that makes all pass Luhn's check."""
    return next(c for c in "0123456789" if luhn(digits[:-1] + c))


def make_item(kind: str | None, form: str, rng: np.random.Generator) -> str:
    out = "".join(
        str(rng.integers(1, 10)) if c == "n" else str(rng.integers(10)) if c == "d"
        else f"{rng.integers(1, 16 ** rng.integers(1, 5)):x}" if c == "h"
        else "".join(chr(97 + k) for k in rng.integers(0, 26, rng.integers(2, 9))) if c == "w" else c for c in form)
    if kind == "card":
        out = out[:-1] + luhn_last(re.sub("[^0-9]", "", out))
    return out


def made_lines(formats: dict[str, list[str]], rounds: int, seed: int) -> list[str]:
    """Marked lines: in each round every format once alone and once beside
    others of its kind (or two of any kind), and every other number."""
    rng = np.random.default_rng(seed)

    def around(body: str) -> str:
        before, after = (" ".join(rng.choice(PLAIN, rng.integers(0, 4))) for _ in range(2))
        lead = rng.choice([" ", " ", ": ", "\n"]) if before else ""
        if rng.random() < 0.1:
            body = f"({body})"
        return before + lead + body + rng.choice(["", "", ".", ","]) + (" " + after if after else "")

    def mark(kind, form):
        return f"[{kind}|{make_item(kind, form, rng)}]"

    lines = []
    for _ in range(rounds):
        for kind, forms in formats.items():
            for form in forms + (LOCAL_FORMATS if kind == "phone" else []):
                if form not in LOCAL_FORMATS:
                    lines.append(around(mark(kind, form)))
                between = rng.choice([" ", ", ", "\n", " and "] if form not in LOCAL_FORMATS else [" ", ", ", "\n"])
                lines.append(around(between.join(mark(kind, form) for _ in range(rng.integers(2, 5)))))
        lines += [around(make_item(None, form, rng)) for form in OTHER + LOCAL_FORMATS]
        lines += [around(rng.choice([" ", "\n"]).join(make_item(None, form, rng) for _ in range(3)))
                  for form in OTHER if " " not in form]
    return lines


def training_lines() -> list[str]:
    return EXAMPLES.strip().splitlines() + made_lines(FORMATS, 6, 9)


def read_marks(line: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The plain text of a marked line, and its spans."""
    out, spans, at, size = [], [], 0, 0
    for m in _MARK.finditer(line):
        out += [line[at:m.start()], m[2]]
        size += m.start() - at
        spans.append((m[1], size, size + len(m[2])))
        at, size = m.end(), size + len(m[2])
    return "".join([*out, line[at:]]), spans


# Shape classes of the bytes: X, x, 9, white space as a blank, others kept; a
# zero that no digit stands before, and the word before a line's end, are told.
_SHAPE = bytes(88 if 65 <= c <= 90 else 120 if 97 <= c <= 122 or c >= 128 else 57 if 49 <= c <= 57
               else 32 if c in (9, 11, 12, 13, 32) else 63 if c == 1 else c for c in range(256))
_INNER_ZERO, _LINE_END = re.compile(rb"(?<=[09])0"), re.compile(rb"(?<=[^ \n]) *\n[ \n]*")
_WORD = re.compile(r"[^ \t\n\v\f\r]+")
_MAYBE = re.compile("[0-9@]")
_TRIM = ".,;:!?\"'#*$%&|<>[]{}=/\\"
_BARE = _TRIM.encode() + b"\x01"


def shapes_of(text: str) -> list[bytes]:
    """The shape of each word."""
    raw = text.encode("utf-8", "surrogatepass").translate(_SHAPE)
    return _LINE_END.sub(b"\x01 ", _INNER_ZERO.sub(b"9", raw)).split()


def digits_of(shape: bytes) -> int:
    return shape.count(b"9") + shape.count(b"0")


def bare_shape(shape: bytes) -> bytes:
    bare = shape.strip(_BARE)
    if bare.startswith(b"::") or shape.lstrip(b"\"'(<[").startswith(b"::"):
        bare = b"::" + bare.lstrip(b":")
    whole = bare.startswith(b"(") and bare.endswith(b")") and len(bare) > 6   # not an area code
    return bare.strip(b"()").strip(_BARE) if whole or (b"(" in bare) != (b")" in bare) else bare


def shape_features(shape: bytes) -> list[str]:
    """What the field sees of a word."""
    bare = bare_shape(shape)
    digits = digits_of(bare)
    alike = bare.replace(b"0", b"9")
    short = re.sub(rb"(.)\1+", rb"\1", alike).decode()
    last = "n" if shape.endswith(b"\x01") else "p" if shape[-1:] in b",;" else "." if shape[-1:] in b".:!?" else ""
    return ["b", "s=" + short[:16], f"d={min(digits, 20)}", f"dd={sum(digits > k for k in (0, 2, 4, 6, 8, 11, 15, 19))}",
            f"l={min(len(bare), 24) // 2}", f"x={b'x' in bare or b'X' in bare}", f"@={bare.count(b'@')}",
            f".={min(bare.count(b'.'), 4)}", f"-={min(bare.count(b'-'), 4)}", f":={min(bare.count(b':'), 8)}",
            f"::={b'::' in bare}", f"+={bare.startswith(b'+')}", f"(={b'(' in bare}", f"z={bare.startswith(b'0')}",
            f"z{min(digits, 20)}={bare.startswith(b'0')}", "end=" + last, "exact=" + alike.decode()[:20]]


def may_be_found(shape: bytes) -> bool:
    return b"9" in shape or b"0" in shape or b"@" in shape


def digits_before(run: list[bytes]) -> list[tuple[int, int]]:
    """For each word of a run, the digits that stand before it since the last
    comma or line end, and its own."""
    out, before = [], 0
    for s in run:
        n = digits_of(s)
        out.append((min(before, 80), min(n, 20)))
        before = 0 if s[-1:] in (b",", b";", b"\x01") else before + n
    return out


def count_features(before: int, own: int) -> list[str]:
    return [f"c={before}", f"c={before},{own}"]


def runs_of(shapes: list[bytes]) -> list[tuple[int, int]]:
    """Longest stretches of words that may be found."""
    found = np.flatnonzero([may_be_found(s) for s in shapes])
    if not len(found):
        return []
    cuts = np.flatnonzero(np.diff(found) > 1)
    return list(zip(found[np.r_[0, cuts + 1]].tolist(), (found[np.r_[cuts, len(found) - 1]] + 1).tolist(), strict=True))


def tag_runs(line: str) -> list[tuple[list[list[str]], list[int]]]:
    """The runs of a marked line: each word's features, and the tags."""
    text, spans = read_marks(line)
    shapes, at = shapes_of(text), [m.span() for m in _WORD.finditer(text)]
    tags = np.zeros(len(at), int)
    for kind, a, b in spans:
        own = [k for k, (c, d) in enumerate(at) if c < b and a < d]
        tags[own] = 2 + 2 * KINDS.index(kind)
        tags[own[0]] -= 1
    out = []
    for a, b in runs_of(shapes):
        rows = []
        for t, extra in zip(range(a, b), digits_before(shapes[a:b]), strict=True):
            row = [*shape_features(shapes[t]), *count_features(*extra)]
            for side, u in (("<", t - 1), (">", t + 1)):
                row += [side + f for f in (shape_features(shapes[u]) if 0 <= u < len(shapes) else ["end"])]
            rows.append(row)
        out.append((rows, tags[a:b].tolist()))
    return out


class Field:
    """Weights of a linear-chain conditional random field.  Tag 0 is "none", tag
    1 + 2k begins kind k and tag 2 + 2k goes on with it."""

    def __init__(self):
        self.tags = (None, *(k for k in KINDS for _ in range(2)))
        k = len(self.tags)
        self.index: dict[str, int] = {}
        self.weights = np.zeros((0, k))
        self.step = np.zeros((k, k))
        # an inside tag stands only behind its own kind
        self.open = np.array([[b == 0 or b % 2 == 1 or a in (b - 1, b) for b in range(k)] for a in range(k)])

    def train(self, runs: list[tuple[list[list[str]], list[int]]], rounds: int = 150, rate: float = 0.5,
              ridge: float = 1e-2) -> Field:
        """Gradient ascent on the conditional likelihood; forward-backward over
        all runs at once, each lying between words of tag 0."""
        k, size = len(self.tags), len(runs)
        lengths = np.array([len(tags) for _, tags in runs])
        longest = int(lengths.max())
        cells = [(r, t, row) for r, (rows, _) in enumerate(runs) for t, row in enumerate(rows)]
        at = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])
        x_rows = [[self.index.setdefault(f, len(self.index)) for f in row] for _, _, row in cells]
        x = np.zeros((len(cells), len(self.index)), np.float32)
        for i, row in enumerate(x_rows):
            x[i, row] = 1
        want = np.eye(k)[np.concatenate([tags for _, tags in runs])]
        want_step = np.zeros((k, k))
        for _, tags in runs:
            np.add.at(want_step, (np.r_[0, tags], np.r_[tags, 0]), 1)
        self.weights = np.zeros((len(self.index), k))
        sums, step_sums = np.full(self.weights.shape, 1e-3), np.full((k, k), 1e-3)
        last = np.arange(size), lengths - 1
        for _ in range(rounds):
            emit = np.ones((size, longest, k))
            score = x @ self.weights.astype(np.float32)
            emit[at] = np.exp(score - score.max(1, keepdims=True))
            move = np.where(self.open, np.exp(self.step), 0)
            fwd, bwd = np.zeros_like(emit), np.zeros_like(emit)
            fwd[:, 0] = move[0] * emit[:, 0]
            fwd[:, 0] /= fwd[:, 0].sum(1, keepdims=True)
            bwd[:, -1] = move[:, 0]
            on = np.arange(longest)[None] < lengths[:, None]
            for t in range(1, longest):
                new = (fwd[:, t - 1] @ move) * emit[:, t]
                fwd[:, t] = np.where(on[:, t, None], new / new.sum(1, keepdims=True), fwd[:, t - 1])
            expect = np.zeros((k, k))
            for t in range(longest - 1, 0, -1):
                ahead = emit[:, t] * bwd[:, t]
                new = ahead @ move.T
                bwd[:, t - 1] = np.where(on[:, t, None], new / new.sum(1, keepdims=True), move[:, 0])
                total = ((fwd[:, t - 1] @ move) * ahead).sum(1)
                expect += move * ((fwd[:, t - 1] * (on[:, t] / total)[:, None]).T @ ahead)
            node = fwd * bwd
            node /= node.sum(2, keepdims=True)
            expect[0] += node[:, 0].sum(0)
            expect[:, 0] += node[last].sum(0)
            grad = x.T @ (want - node[at]).astype(np.float32) - ridge * self.weights
            step_grad = np.where(self.open, want_step - expect - ridge * self.step, 0)
            sums += grad ** 2
            step_sums += step_grad ** 2
            self.weights += rate * grad / np.sqrt(sums)
            self.step += rate * step_grad / np.sqrt(step_sums)
        self.step = np.where(self.open, self.step, -1e9)
        return self

    def score(self, names: list[str]) -> np.ndarray:
        return self.weights[[self.index[f] for f in names if f in self.index]].sum(0)


def viterbi(emit: np.ndarray, lengths: np.ndarray, step: np.ndarray, none: int = 0) -> np.ndarray:
    """Best tags of a batch of runs, ``emit`` of shape (runs, longest, tags).
    A run lies between words of tag ``none``."""
    runs, longest, k = emit.shape
    best = emit[:, 0] + step[none][None]
    back = np.zeros((runs, longest, k), np.int8)
    for t in range(1, longest):
        through = best[:, :, None] + step[None]
        back[:, t] = through.argmax(1)
        on = (t < lengths)[:, None]
        best = np.where(on, through.max(1) + emit[:, t], best)
    tag = (best + step[:, none][None]).argmax(1)
    out = np.zeros((runs, longest), np.int8)
    for t in range(longest - 1, -1, -1):
        here = t < lengths
        out[here, t] = tag[here]
        tag = np.where(here & (t > 0), back[np.arange(runs), t, tag], tag)
    return out


@cache
def trained() -> Field:
    return Field().train([run for line in training_lines() for run in tag_runs(line)])


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern spans by kind as listed, then start."""
    out = []
    if "@" in text:  # no part of an address is white space
        out += [("email", c.start() + m.start(), c.start() + m.end())
                for c in CHUNK.finditer(text) for m in EMAIL.finditer(c[0])]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def passes(kind: str, words: str) -> bool:
    """The check of a field span's text."""
    digits = re.sub("[^0-9]", "", words)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", words)
    if kind == "phone":
        return not re.search(r"[^0-9 ().+-]", words) and (
            9 <= len(digits) <= 15 or len(digits) == 7 and bool(re.fullmatch(r"[0-9]{3}[.-][0-9]{4}", words)))
    if kind == "ip":
        return words.count(":") >= 2 and bool(re.fullmatch(r"[0-9A-Fa-f:]+", words)) and (
            words.count("::") == 1 and words.count(":") <= 7 or words.count(":") == 7) and (
            ":::" not in words and all(len(p) <= 4 for p in words.split(":")) and bool(digits))
    return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+", words))


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without outer punctuation and brackets that do not close in it
    or hold all of it."""
    def outer(c):
        return c in _TRIM or c == "-" or c in "()" and (("(" in text[start:end]) != (")" in text[start:end]))

    while True:
        was = start, end
        while start < end and outer(text[start]) and not text.startswith("::", start):
            start += 1
        while end > start and outer(text[end - 1]):
            end -= 1
        if text[start:start + 1] == "(" and text[end - 1:end] == ")" and "(" not in text[start + 1:end]:
            start, end = start + 1, end - 1
        if (start, end) == was:
            return start, end


class Decoder:
    """Field spans of texts, a batch at a time.  Scores of a shape are kept;
    there are few different shapes."""

    def __init__(self, field: Field, keep: int = 50_000):
        self.field, self.keep = field, keep
        self.known: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.ends = [field.score(["<end"]), field.score([">end"])]
        self.counts: dict[tuple[int, int], np.ndarray] = {}

    def of(self, shape: bytes):
        got = self.known.get(shape)
        if got is None:
            if len(self.known) >= self.keep:
                self.known.clear()
            names = shape_features(shape)
            got = self.known[shape] = (self.field.score(names), self.field.score(["<" + f for f in names]),
                                       self.field.score([">" + f for f in names]))
        return got

    def count(self, before: int, own: int) -> np.ndarray:
        got = self.counts.get((before, own))
        if got is None:
            got = self.counts[before, own] = self.field.score(count_features(before, own))
        return got

    def __call__(self, tx: list[str]) -> list[list[tuple[str, int, int]]]:
        runs: list[tuple[int, int, np.ndarray]] = []
        for i, text in enumerate(tx):
            if not _MAYBE.search(text):
                continue
            shapes = shapes_of(text)
            for a, b in runs_of(shapes):
                own = [self.of(s) for s in shapes[a:b]]
                before = self.of(shapes[a - 1])[1] if a else self.ends[0]
                after = self.of(shapes[b])[2] if b < len(shapes) else self.ends[1]
                left = [before, *(o[1] for o in own[:-1])]
                right = [*(o[2] for o in own[1:]), after]
                counts = [self.count(*n) for n in digits_before(shapes[a:b])]
                runs.append((i, a, np.array([o[0] for o in own]) + np.array(left) + np.array(right) + np.array(counts)))
        out: list[list[tuple[str, int, int]]] = [[] for _ in tx]
        runs.sort(key=lambda r: len(r[2]))
        while runs:
            # of the longest runs so many that their table stays small
            part = runs[-max(1, min(512, CELLS // len(runs[-1][2]))):]
            del runs[-len(part):]
            lengths = np.array([len(r[2]) for r in part])
            emit = np.zeros((len(part), lengths.max(), len(self.field.tags)))
            for k, r in enumerate(part):
                emit[k, :len(r[2])] = r[2]
            tags = viterbi(emit, lengths, self.field.step)
            for k in np.flatnonzero(tags.any(1)):
                i, a, _ = part[k]
                row = tags[k, :lengths[k]]
                for t in np.flatnonzero(row % 2 == 1).tolist():
                    n = 1
                    while t + n < len(row) and row[t + n] == row[t] + 1:
                        n += 1
                    out[i].append((self.field.tags[row[t]], a + t, a + t + n))
        return [self.place(text, words) if words else [] for text, words in zip(tx, out, strict=True)]

    def place(self, text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Spans of words as spans of code points, outer punctuation left out;
        those that pass their kind's check."""
        at = [m.span() for m in _WORD.finditer(text)]
        out = []
        for kind, a, b in sorted(spans, key=lambda s: s[1]):
            start, end = trimmed(text, at[a][0], at[b - 1][1])
            if passes(kind, text[start:end]):
                out.append((kind, start, end))
        return out


def all_spans(tx: list[str], decode: Decoder) -> list[tuple[list, list]]:
    """Per text its pattern spans, and those with the field's added."""
    out = []
    for text, more in zip(tx, decode(tx), strict=True):
        base = base_spans(text)
        added = [s for s in more if not any(s[1] < e and b < s[2] for _, b, e in base)]
        out.append((base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
    return out


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping ones, as its kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of its pattern spans, their digest, all
    spans, and the text with all spans masked."""
    docs = id_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    fields = {"doc_id": dict(docs.dtypes)["doc_id"].replace("bigint", "long"), **{f"n_{k}": "long" for k in KINDS},
              "base_sha256": "string", "spans": "string", "masked": "string"}

    def make():
        decode = Decoder(shared.value)

        def run(batch):
            tx = texts(batch)
            out = {k: [] for k in fields}
            out["doc_id"] = column(batch, "doc_id")
            for text, (base, every) in zip(tx, all_spans(tx, decode), strict=True):
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(every))
                out["masked"].append(mask(text, every))
            return out
        return run

    return map_batches(docs, make, fields)


def mask_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows with every span of their texts masked; all other columns stay,
    but a column of text lengths follows the text.  Null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def make():
        decode = Decoder(shared.value)

        def run(batch):
            tx = texts(batch, text_col)
            new = [mask(t, every) for t, (_, every) in zip(tx, all_spans(tx, decode), strict=True)]
            old = column(batch, text_col)
            cells = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            cells[text_col] = pa.array([t if v else None for t, v in zip(new, old.is_valid().to_pylist(), strict=True)],
                                       old.type)
            if length_col in cells:
                lengths = [len(t) if t != was else n for t, was, n in
                           zip(new, tx, cells[length_col].to_pylist(), strict=True)]
                cells[length_col] = pa.array(lengths, cells[length_col].type)
            return pa.RecordBatch.from_arrays(list(cells.values()), schema=batch.schema)
        return run

    return rewrite_batches(docs, make)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
