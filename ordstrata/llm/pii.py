"""Personal data: fixed patterns, and a semi-Markov conditional random field over spans."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordstrata.llm.common import Cache, shared

KINDS = ("email", "ip", "card", "phone")
# The base patterns; possessive forms match the same and stay linear.
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]")
HOST_GOES_ON = re.compile(r"\.?[A-Za-z0-9-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]")

MOST_TOKENS = 20  # of one candidate span
MOST_CHARS = 64
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s|.", re.DOTALL)

# A small labelled table: text, and the spans in it as (kind, part). Hand-made.
LABELLED = [
    ("write to ana.silva@mail.example.org today", [("email", "ana.silva@mail.example.org")]),
    ("<bob_7@site.example.net>", [("email", "bob_7@site.example.net")]),
    ("kim@example.com, lee@example.com", [("email", "kim@example.com"), ("email", "lee@example.com")]),
    ("mail user@localhost now", []),
    ("@handle99 said", []),
    ("at 5 @ noon", []),
    ("price@2 each", []),
    ("call (312) 555-0142 now", [("phone", "(312) 555-0142")]),
    ("tel. 312-555-0178", [("phone", "312-555-0178")]),
    ("tel 0049 30 1234567", [("phone", "0049 30 1234567")]),
    ("+1 (743) 555-3824", [("phone", "+1 (743) 555-3824")]),
    ("+44 20 7946 0958!!", [("phone", "+44 20 7946 0958")]),
    ("555-0142", []),
    ("in 2019 and 2020", []),
    ("on 2021-03-14 at 10:30", []),
    ("12/11/2020", []),
    ("14.03.2021", []),
    ("version 1.2.3", []),
    ("section 4.2.1.7.3", []),
    ("host 10.0.0.7 up", [("ip", "10.0.0.7")]),
    ("[192.168.100.200]", [("ip", "192.168.100.200")]),
    ("233.233.171.252!!", [("ip", "233.233.171.252")]),
    ("300.1.2.999", []),
    ("999.888.777.666", []),
    ("4111 1111 1111 1111", [("card", "4111 1111 1111 1111")]),
    ("4111-1111-1111-1111$$$", [("card", "4111-1111-1111-1111")]),
    ("card 4111.1111.1111.1111", [("card", "4111.1111.1111.1111")]),
    ("5500005555555559###", [("card", "5500005555555559")]),
    ("4111111111111112", []),
    ("9870157079875996", []),
    ("id 1234567890123456", []),
    ("1000000", []),
    ("3.14159265358979", []),
    ("token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"", []),
    ("5731080387325255 of", []),
    ("a1b2c3d4", []),
    ("\"f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda\"", []),
    ("sha 9b0b3c6a43eb78aa1ab85687d33eeaaf9ac699e1", []),
    ("A4 B12 7th 3D mp3", []),
    ("17 18 19 20 21 22", []),
    ("00123456789012", []),
]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and without overlap within a kind."""
    found = []
    if "@" in text:
        after, at = 0, text.find("@")
        while at >= 0:
            begin = at
            while begin > after and EMAIL_NAME.match(text, begin - 1):
                begin -= 1
            host = EMAIL_HOST.match(text, at) if begin < at else None
            after = host.end() if host else at + 1
            if host:
                found.append((begin, 0, after))
            at = text.find("@", after)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def islands(text: str) -> list[tuple[int, str]]:
    """(start, text) of the stretches that can hold a span: characters around digits and @ up to
    white space or ``MOST_CHARS`` past the outermost sign, joined where only one blank lies between.
    A stretch has any length: it ends only at wider space, beside pieces without a digit or @, or
    where a span of at most ``MOST_CHARS`` characters around a sign cannot reach."""
    found: list[list[int]] = []
    for m in SIGN.finditer(text):
        at = m.start()
        begin = at
        floor = max(0, at - MOST_CHARS, found[-1][1] if found else 0)
        while begin > floor and not text[begin - 1].isspace():
            begin -= 1
        end = max(m.end(), found[-1][1] if found else 0)
        while end < len(text) and end - at < MOST_CHARS and not text[end].isspace():
            end += 1
        if found and begin - found[-1][1] <= 1:
            found[-1][1] = end
        else:
            found.append([begin, end])
    return [(a, text[a:b]) for a, b in found]


def span_features(text: str, start: int, end: int) -> list[str]:
    """What a candidate span as a whole looks like, and what stands beside it."""
    s = text[start:end]
    before, after = text[start - 1 : start], text[end : end + 1]
    digits = "".join(c for c in s if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in s)
    marks = "".join(sorted({c for c in s if not c.isalnum()}))
    parts = s.split(".")
    out = [
        "any",
        f"marks={marks}" if len(marks) <= 4 else "marks=many",
        f"digits={min(len(digits), 20)}",
        f"first={'digit' if s[0].isdigit() else 'letter' if s[0].isalpha() else s[0]}",
        f"last={'digit' if s[-1].isdigit() else 'letter' if s[-1].isalpha() else s[-1]}",
        f"letters={'some' if letters else 'none'},signs={s.count('@')}",
        f"inside_word={before.isalnum() or after.isalnum()}",
        f"beside={before if before in '.@+-(/' else ''}|{after if after in '@-)/' else ''}",
    ]
    if "@" in s:
        name, _, host = s.partition("@")
        whole = bool(name) and "@" not in host and EMAIL_HOST.fullmatch("@" + host)
        out.append(f"address={bool(whole) and all(map(EMAIL_NAME.match, name))}")
        more = EMAIL_NAME.match(text, start - 1) if start else None
        out.append(f"address_goes_on={bool(more or HOST_GOES_ON.match(text, end))}")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        out.append(f"octets={all(len(p) <= 3 and int(p) <= 255 for p in parts)}")
    if not letters and 12 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
        out.append(f"luhn={luhn(digits)},{len(set(marks))}")
    if not letters and 9 <= len(digits) <= 15:
        groups = len(re.findall("[0-9]+", s))
        out.append(f"groups={min(groups, 6)},{s[0] if not s[0].isdigit() else 'digit'}")
        out.append(f"dialled={s[0] == '+' or '(' in s or s.startswith('00')},{groups >= 3}")
    return out


def token_borders(text: str) -> list[int]:
    return [0, *(m.end() for m in TOKEN.finditer(text))]


def candidates(text: str, borders: list[int]) -> Iterator[tuple[int, int, list[str]]]:
    """The candidate spans between token borders, by where they begin: bounded, with a digit or an
    @, and neither beginning nor ending with white space."""
    for i in range(len(borders) - 1):
        if text[borders[i]].isspace():
            continue
        for j in range(i + 1, min(i + MOST_TOKENS, len(borders) - 1) + 1):
            if borders[j] - borders[i] > MOST_CHARS:
                break
            part = text[borders[i] : borders[j]]
            if not part[-1].isspace() and SIGN.search(part):
                yield i, j, span_features(text, borders[i], borders[j])


def added(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


class SpanField:
    """Scores of whole candidate spans; a text's labelling is a sequence of spans and single
    tokens outside, and its probability is the exponential of its spans' scores, normalised."""

    def __init__(self):
        self.weights: dict[tuple[int, str], float] = {}

    def scores(self, features: list[str]) -> list[float]:
        get = self.weights.get
        return [sum(get((k, f), 0.0) for f in features) for k in range(len(KINDS))]

    def fit(self, texts: list[tuple[str, set]], rounds: int = 15, rate: float = 0.5) -> SpanField:
        """Adaptive gradient steps on the log-likelihood of (text, {(start, kind, end)}), by the
        forward and backward sums over all segmentations."""
        squares: dict[tuple[int, str], float] = {}
        prepared = []
        for text, spans in texts:
            borders = token_borders(text)
            found = list(candidates(text, borders))
            place = {b: i for i, b in enumerate(borders)}
            gold = {(place.get(a), place.get(b)): k for a, k, b in spans}
            prepared.append((len(borders) - 1, found, gold))
        for _ in range(rounds):
            for n, found, gold in prepared:
                scored = [(i, j, f, self.scores(f)) for i, j, f in found]
                forward = [0.0] + [-math.inf] * n
                ending: list[list] = [[] for _ in range(n + 1)]
                starting: list[list] = [[] for _ in range(n + 1)]
                for span in scored:
                    ending[span[1]].append(span)
                    starting[span[0]].append(span)
                for j in range(1, n + 1):
                    forward[j] = forward[j - 1]
                    for i, _, _, s in ending[j]:
                        for x in s:
                            forward[j] = added(forward[j], forward[i] + x)
                backward = [-math.inf] * n + [0.0]
                for i in range(n - 1, -1, -1):
                    backward[i] = backward[i + 1]
                    for _, j, _, s in starting[i]:
                        for x in s:
                            backward[i] = added(backward[i], backward[j] + x)
                slope: dict[tuple[int, str], float] = {}
                for i, j, features, s in scored:
                    for k, x in enumerate(s):
                        expected = math.exp(min(0.0, forward[i] + x + backward[j] - forward[n]))
                        change = (gold.get((i, j)) == k) - expected
                        if abs(change) > 1e-3:
                            for f in features:
                                slope[k, f] = slope.get((k, f), 0.0) + change
                for at, g in slope.items():
                    squares[at] = squares.get(at, 0.0) + g * g
                    w = self.weights.get(at, 0.0)
                    self.weights[at] = w + rate * g / math.sqrt(squares[at])
        return self

    def decode(self, text: str) -> list[tuple[int, int, int]]:
        """The best labelling: boundaries and kinds chosen together. Candidates are scored as they
        come and not kept, so a stretch may have any length."""
        borders = token_borders(text)
        n = len(borders) - 1
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        at = 0
        for i, j, features in candidates(text, borders):
            for at in range(at + 1, i + 1):
                if best[at - 1] >= best[at]:
                    best[at], back[at] = best[at - 1], None
            for k, x in enumerate(self.scores(features)):
                if x > 0 and best[i] + x > best[j]:
                    best[j], back[j] = best[i] + x, (i, k)
        for at in range(at + 1, n + 1):
            if best[at - 1] >= best[at]:
                best[at], back[at] = best[at - 1], None
        spans, j = [], n
        while j:
            if back[j]:
                i, k = back[j]
                spans.append((borders[i], k, borders[j]))
                j = i
            else:
                j -= 1
        return spans[::-1]


def labelled_table() -> list[tuple[str, set]]:
    out = []
    for text, parts in LABELLED:
        spans = set()
        for kind, part in parts:
            at = text.index(part)
            spans.add((at, KINDS.index(kind), at + len(part)))
        for at, island in islands(text):
            inside = {(a - at, k, b - at) for a, k, b in spans if at <= a and b <= at + len(island)}
            out.append((island, inside))
    return out


def train(docs: DataFrame, sample: int = 400, most_stretches: int = 300) -> SpanField:
    """A field fitted to the labelled table and to what the base patterns find in at most
    ``most_stretches`` stretches of different shape, from at most 50 of each of at most ``sample``
    texts: those of least hash with a digit or an @."""

    def stretches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: [x for _, x in islands(t) if len(x) <= MOST_CHARS][:50])

    signed = docs.filter(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("h"), "text")
    # Only hashes are sorted; texts are read again below the last of them.
    last = signed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    sampled = signed.filter(F.col("h") <= F.lit(last)).dropDuplicates(["h"]).orderBy("h")
    rows = sampled.select(F.pandas_udf(stretches, "array<string>")("text").alias("found")).collect()
    shapes = {re.sub("[^\\W_]", "a", x): x for row in rows for x in row.found}
    texts = [(x, set(base_spans(x))) for x in list(shapes.values())[:most_stretches]]
    return SpanField().fit(texts + labelled_table() * 2)


def all_spans(text: str, decoded: Cache) -> tuple[list, list]:
    """The base spans of a text, and all its spans: the field's, where they touch no base span."""
    if not SIGN.search(text):
        return [], []
    base = base_spans(text)
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))
    spans = list(base)
    for at, island in islands(text):
        # Long stretches hardly come twice and would fill the memory.
        known = decoded[island] if len(island) <= 2 * MOST_CHARS else decoded.make(island)
        for a, k, b in known:
            before = bisect_left(starts, b + at)
            if not before or reach[before - 1] <= a + at:
                spans.append((a + at, k, b + at))
    return base, sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def personal_data(docs: DataFrame, field: SpanField | None = None) -> DataFrame:
    """doc_id, counts of the base patterns, their digest, and all spans of every row of ``docs``.

    Candidate spans of at most 20 tokens and 64 characters around digits and @ are scored as wholes;
    dynamic programming over each stretch chooses boundaries and kinds together. The field adds
    spans where the base patterns have none. Positions are code points, ends exclusive.

    A null text counts as empty. Texts of any length are searched whole, in linear time. Repeated
    rows and rows without doc_id are searched like others. An empty table gives no rows (the field
    is then fitted to its labelled table alone). Further columns are not read.
    """
    fitted = shared(docs.sparkSession, field or train(docs))

    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        decoded = Cache(fitted().decode, 50_000)
        for texts in batches:
            out = []
            for text in texts:
                base, spans = all_spans(text or "", decoded)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                out.append((*counts, digest, joined(spans)))
            names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            yield pd.DataFrame(out, columns=names)

    found = F.pandas_udf(find, FOUND)("text")
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.*")


def redacted(docs: DataFrame, field: SpanField | None = None) -> DataFrame:
    """``docs`` with each span of its texts replaced by its kind in capitals and brackets; a column
    ``n_chars`` follows the new text. Null texts stay null."""
    fitted = shared(docs.sparkSession, field or train(docs))

    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoded = Cache(fitted().decode, 50_000)

        def one(text: str | None) -> str | None:
            if text is None or not SIGN.search(text):
                return text
            out, at = [], 0
            for a, k, b in all_spans(text, decoded)[1]:
                if a >= at:
                    out += [text[at:a], f"[{KINDS[k].upper()}]"]
                at = max(at, b)
            return "".join([*out, text[at:]])

        for texts in batches:
            yield texts.map(one)

    out = docs.withColumn("text", F.pandas_udf(replace, "string")("text"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(length, "n_chars"))
    return out
