"""Personal data in texts: exact base patterns, and a semi-Markov CRF that adds spans written in other ways.

Base spans are the leftmost non-overlapping matches of a kind that pass its test (octets, Luhn sum, digit count). Between
them the CRF looks at stretches around digits and at-marks: candidate segments are runs of atoms that could be a number or
an address, whole-segment features score them, and dynamic programming over bounded segments picks boundaries and types
together. The model is fitted in the driver on a bounded sample: at most ``Settings.windows`` stretches of the corpus,
the ones with the smallest hashes, labelled by the base patterns, plus rewritten forms of their entities ("name (at)
host", dotted and bare numbers), and the fixed ``SEEDS``.

Texts are read whole; null counts as empty and gives no spans. Repeated rows and ids are treated one by one, other columns
are left aside. The scan is row-local; only the sample reaches the driver.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.common import beside, texts_of
from tallycart.llm.semicrf import Lattice, best, fit

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# The patterns that fix the base spans. The look-behind only saves time: a match can't begin later within the same run.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
EMAIL_FRESH = re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL.pattern)
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

HOT = re.compile(r"[0-9@]|[\[({<] ?[aA][tT] ?[\])}>]")
SPELT = re.compile(r"[\[({<] ?[aA][tT] ?[\])}>]")
TOKEN_REST, AHEAD, BEHIND = re.compile(r"\S*+"), re.compile(r"(?:\s++\S++){0,3}"), re.compile(r"(?:\S++\s++){0,3}\S*+\Z")
ATOM = re.compile(r"[A-Za-z]+|[0-9]+|\s+|.", re.DOTALL)
AT = re.compile(r"@|(?<=[A-Za-z0-9])\s*[\[({<]\s*at\s*[\])}>]\s*(?=[A-Za-z0-9])|(?<=[A-Za-z0-9]) at (?=[A-Za-z0-9])", re.IGNORECASE)
DOT = re.compile(r"\.|\s*[\[({<]\s*dot\s*[\])}>]\s*| dot ", re.IGNORECASE)
NUMERIC = re.compile(r"[+(]{0,2}[0-9][0-9 ().,/-]*")
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+(?:[^\n]*)[A-Za-z]{2,}")
CUES = {
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telefon", "whatsapp", "sms"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "tarjeta", "carte"),
    "ip": ("ip", "host", "server", "address", "addr", "from"),
    "email": ("mail", "email", "contact", "write", "to", "e-mail"),
}
CUE_OF = {w: k for k, words in CUES.items() for w in words}
#: Longest candidate segment in atoms.
LONGEST = 28

#: Windows that are always in the training set: text, spans by kind.
SEEDS: tuple[tuple[str, tuple[tuple[str, str], ...]], ...] = (
    ("write to jane.roe (at) mail (dot) example (dot) com today", (("email", "jane.roe (at) mail (dot) example (dot) com"),)),
    ("mail jroe [at] example [dot] org please", (("email", "jroe [at] example [dot] org"),)),
    ("call 555-201-7788 before noon", (("phone", "555-201-7788"),)),
    ("tel (020) 7946 0958 or fax", (("phone", "(020) 7946 0958"),)),
    ("phone 030.123.45678 daily", (("phone", "030.123.45678"),)),
    ("mobile 0170 1234567 thanks", (("phone", "0170 1234567"),)),
    ("card 4111.1111.1111.1111 was used", (("card", "4111.1111.1111.1111"),)),
    ("visa 4111/1111/1111/1111 was used", (("card", "4111/1111/1111/1111"),)),
    ("server 10 . 0 . 0 . 12 is down", (("ip", "10 . 0 . 0 . 12"),)),
    ("host 192,168,1,20 is down", (("ip", "192,168,1,20"),)),
    ("reach +1 (212) 555-0134 4111111111111111 now", (("phone", "+1 (212) 555-0134"), ("card", "4111111111111111"))),
    ("or +44 20 7946 0958 and 5500005555555559 too", (("phone", "+44 20 7946 0958"), ("card", "5500005555555559"))),
    ("version 4.0.1 of 2021-03-04 at 10:30", ()),
    ("isbn 978-3-16-148410-0 in print", ()),
    ("card 4111 1111 1111 1112 fails the check", ()),
    ("order 20210304 for 1,250.00 paid on 12/11/2023", ()),
    ("pages 120-135 and 140-151 of volume 12", ()),
    ("meet at 10 or at 12 in room 204", ()),
    ("the value 3.14159 and 2.71828 in table 7", ()),
    ("number 1234567890123456 is not valid", ()),
    ("id 00012345678 and build 20240115.3", ()),
    ("between 1990 2000 2010 2020 the counts were 100 200 300", ()),
)


@dataclass(frozen=True)
class Settings:
    windows: int = 400
    epochs: int = 6


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0


def emails(text: str) -> list[Span]:
    out, at = [], 0
    while m := EMAIL_FRESH.search(text, at) or None:
        out.append(m.span())
        at = m.end()
        while again := EMAIL.match(text, at):  # right behind a match a new one may begin within a run
            out.append(again.span())
            at = again.end()
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    """The base spans of each kind."""
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if DIGIT.search(text):
        if text.count(".") > 2:
            out["ip"] = [m.span() for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x) < 256 for x in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def stretches(text: str) -> Iterator[Span]:
    """Stretches of tokens around digits and at-marks, three tokens to either side (160 characters to the left at most),
    joined where they meet."""
    if not ("@" in text or DIGIT.search(text) or (any(x in text for x in "[({<") and SPELT.search(text))):
        return
    begin, end, at = -1, -1, 0
    while m := HOT.search(text, at):
        behind = text[max(0, m.start() - 160) : m.start()]
        left = m.start() - len(behind) + BEHIND.search(behind).start()
        if begin >= 0 and left > end:
            yield begin, end
            begin = -1
        begin = left if begin < 0 else begin
        at = TOKEN_REST.match(text, m.end()).end()
        end = AHEAD.match(text, at).end()
    if begin >= 0:
        yield begin, end


def features(text: str, start: int, end: int) -> list[str] | None:
    """Features of the whole segment; None if it can't be an entity."""
    s = text[start:end]
    digits = NOT_DIGIT.sub("", s)
    left = text[start - 1] if start else " "
    right = text[end] if end < len(text) else " "
    if NUMERIC.fullmatch(s) and 4 <= len(digits) <= 24:
        groups = re.findall(r"[0-9]+", s)
        marks = "".join(sorted(set(re.sub(r"[0-9]", "", s))))
        out = ["number", f"digits {len(digits)}", f"marks {marks}", f"groups {len(groups)}"]
        out.append("shape " + "-".join(str(len(g)) for g in groups[:6]))
        if 13 <= len(digits) <= 19:
            out.append("luhn" if luhn(digits) else "no luhn")
        if len(groups) == 4 and all(int(g) < 256 for g in groups):
            out.append("quad " + marks)
        out += ["plus"] * s.startswith("+") + ["zero"] * s.startswith("0") + ["paren"] * ("(" in s)
    elif AT.search(s) and ADDRESS.fullmatch(s):
        head, *tails = AT.split(s)
        if len(tails) != 1 or not head or " " in head or not DOT.search(tails[0]):
            return None
        parts = DOT.split(tails[0])
        if not all(re.fullmatch(r"[A-Za-z0-9-]+", p) for p in parts):
            return None
        out = ["address", "plain at" if "@" in s else "spelt at" if re.search(r"[\[({<]", s) else "bare at", f"parts {len(parts)}"]
        out.append("known tail" if parts[-1].lower() in ("com", "org", "net", "edu", "de", "fr", "es", "eu", "io") else "other tail")
    else:
        return None
    if left.isalnum() or right.isalnum() or left in "@_=" or right in "@_":
        out.append("cut word")
    if right in "-." and text[end + 1 : end + 2].isdigit() or left in "-./" and text[start - 2 : start - 1].isdigit():
        out.append("cut number")
    words = re.findall(r"[A-Za-z]+", text[max(0, start - 24) : start])
    out.append("cue " + next((CUE_OF[w.lower()] for w in reversed(words[-2:]) if w.lower() in CUE_OF), "none"))
    return out


def candidates(text: str, begin: int, end: int, blocked: list[Span]) -> tuple[list[int], list[tuple[int, int, list[str]]]]:
    """Atom boundaries of a stretch and its possible segments (by atom), sorted by end; none touches a blocked span."""
    bounds = [begin, *(m.end() for m in ATOM.finditer(text, begin, end))]
    found = []
    for j in range(1, len(bounds)):
        if not (text[bounds[j] - 1].isalnum() or text[bounds[j] - 1] == ")"):
            continue
        for i in range(j - 1, max(-1, j - 1 - LONGEST), -1):
            a, b = bounds[i], bounds[j]
            if text[a] == "\n" or any(a < y and x < b for x, y in blocked):
                break
            if (text[a].isalnum() or text[a] in "+(") and b - a > 3:
                f = features(text, a, b)
                if f:
                    found.append((i, j, f))
    return bounds, found


def lattice(bounds: list[int], found: list[tuple[int, int, list[str]]], numbers: dict[str, int]) -> Lattice:
    width = max((len(f) for *_, f in found), default=1)
    table = np.full((len(found), width), -1, dtype=np.int64)
    for row, (*_, f) in enumerate(found):
        known = [numbers[x] for x in f if x in numbers]
        table[row, : len(known)] = known
    return Lattice(len(bounds) - 1, np.array([x[0] for x in found], dtype=int), np.array([x[1] for x in found], dtype=int), table)


@dataclass(frozen=True)
class Model:
    numbers: dict[str, int]
    weights: np.ndarray

    def added(self, text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
        """Spans that the CRF adds beside the base spans."""
        blocked = sorted(x for spans in base.values() for x in spans)
        out, k = [], 0
        for begin, end in stretches(text):
            while k < len(blocked) and blocked[k][1] <= begin:
                k += 1
            near = [x for x in blocked[k : k + 64 + end - begin] if x[0] < end] if k < len(blocked) else []
            bounds, found = candidates(text, begin, end, near)
            if found:
                net = lattice(bounds, found, self.numbers)
                out += [(KINDS[kind], bounds[i], bounds[j]) for i, j, kind in best(net, net.scores(self.weights))]
        return out


def rewritten(window: str, base: dict[str, list[Span]], turn: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The window with each base span in another usual form, and where the new forms stand."""
    forms = {
        "email": lambda s: re.sub(r"\.(?=[A-Za-z-]+(\.|$))", " (dot) ", s.replace("@", " (at) ")) if turn % 2 else s.replace("@", " [at] ").replace(".", " [dot] ", 0),
        "ip": lambda s: s.replace(".", " . ") if turn % 2 else s.replace(".", ","),
        "card": lambda s: (".", "/")[turn % 2].join(d[i : i + 4] for d in [NOT_DIGIT.sub("", s)] for i in range(0, len(d), 4)),
        "phone": lambda s: ("-", ".", " ")[turn % 3].join((d := NOT_DIGIT.sub("", s))[-10:][a:b] for a, b in ((0, 3), (3, 6), (6, 10))),
    }
    out, gold, at = "", [], 0
    for a, b, kind in sorted((a, b, kind) for kind, spans in base.items() for a, b in spans):
        if a < at:
            continue
        out += window[at:a]
        new = forms[kind](window[a:b])
        gold.append((kind, len(out), len(out) + len(new)))
        out, at = out + new, b
    return out + window[at:], gold


def trained(windows: list[str], settings: Settings) -> Model:
    """The model from corpus windows and the seeds; the order of the windows fixes the result."""
    labelled = [(text, [(k, text.index(s), text.index(s) + len(s)) for k, s in spans]) for text, spans in SEEDS]
    for turn, window in enumerate(windows):
        base = base_spans(window)
        labelled.append((window, [(k, a, b) for k, spans in base.items() for a, b in spans]))
        if any(base.values()):
            labelled.append(rewritten(window, base, turn))
    drawn = []
    for text, gold in labelled:
        bounds, found = candidates(text, 0, len(text), [])
        wanted = {(a, b): k for k, a, b in gold}
        rows = [(row, KINDS.index(wanted[bounds[i], bounds[j]])) for row, (i, j, _) in enumerate(found) if (bounds[i], bounds[j]) in wanted]
        if found and len(rows) == len(gold):
            drawn.append((bounds, found, rows))
    numbers = {f: k for k, f in enumerate(sorted({f for _, found, _ in drawn for *_, fs in found for f in fs}))}
    examples = [(lattice(bounds, found, numbers), rows) for bounds, found, rows in drawn]
    return Model(numbers, fit(examples, len(numbers), len(KINDS), settings.epochs))


def sample_windows(docs: DataFrame, text_col: str, limit: int) -> list[str]:
    """The ``limit`` distinct stretches of the corpus with the smallest hashes, of at most 200 characters each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for text in texts_of(batch.column(0)):
                for a, b in stretches(text):
                    if b - a <= 200:
                        found[hashlib.md5(text[a:b].encode("utf-8", "surrogatepass")).hexdigest()] = text[a:b]
            least = sorted(found)[:limit]  # no batch can give more to the sample
            yield pa.RecordBatch.from_arrays([pa.array(least, pa.string()), pa.array([found[k] for k in least], pa.string())], ["k", "w"])

    rows = docs.select(F.col(text_col).alias("t")).mapInArrow(cut, "k string, w string").distinct().orderBy("k").limit(limit).collect()
    return [r.w for r in rows]


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """Per document: counts of base spans by kind, the digest of the base spans, and all spans as kind:start:end."""
    settings = settings or Settings()
    model = trained(sample_windows(docs, text_col, settings.windows), settings)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {dict(slim.dtypes)['doc_id']}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts_of(batch.column("text")):
                base = base_spans(text)
                flat = [(k, a, b) for k in KINDS for a, b in base[k]]
                added = model.added(text, base)
                everything = sorted({*flat, *added}, key=lambda x: (KINDS.index(x[0]), x[1], x[2])) if added else flat
                rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(listed(flat).encode()).hexdigest(), listed(everything), len(added)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names)

    return slim.mapInArrow(run, schema)


def masked(text: str, spans: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its kind."""
    if not spans:
        return text
    out, at = [], 0
    parts = sorted((int(a), -int(b), k) for k, a, b in (x.split(":") for x in spans.split(",")))
    for a, b, kind in parts:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, -b)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", settings: Settings | None = None) -> DataFrame:
    """The rows with all spans of their texts replaced by the names of their kinds, and the length column, if it is
    there, counted anew. Null texts stay null."""
    settings = settings or Settings()
    model = trained(sample_windows(docs, text_col, settings.windows), settings)

    def fresh() -> Callable[[list[str]], list]:
        def made(texts: list[str]) -> list:
            out = []
            for text in texts:
                base = base_spans(text)
                spans = [(k, a, b) for k in KINDS for a, b in base[k]] + model.added(text, base)
                out.append(masked(text, listed(spans)))
            return [pa.array(out, pa.string())]

        return made

    rows = beside(docs, text_col, "masked string", fresh)
    new = F.when(F.col(f"row.`{text_col}`").isNotNull(), F.col("masked"))
    columns = []
    for name, kind in docs.dtypes:
        old = F.col(f"row.`{name}`")
        if name == text_col:
            old = new
        elif name == length_col:
            old = F.when(new.isNotNull(), F.char_length(new).cast(kind)).otherwise(old)
        columns.append(old.alias(name))
    return rows.select(*columns)
