"""Personal data by rules, and by a semi-Markov conditional random field.

The rules find e-mail addresses, IP addresses, card numbers and phone numbers in
their usual form. The random field adds those in other forms ("name (at) host dot
org", "10[.]0[.]0[.]7", national phone numbers): candidate segments of bounded
length are scored as whole spans by features such as their shape, number of
digits, checksum and neighbours, and dynamic programming picks boundaries and
kinds of a stretch of text jointly. Spans of the rules always stay; added spans
never overlap them.

Narrow: one pass over whole texts, no shuffle. The model is trained on the driver
from a fixed number of made-up sentences (`TRAINING_SENTENCES`, fixed seed), so
it doesn't depend on the data, and has some hundred weights.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Kinds in order of their listing.
KINDS = ("email", "ip", "card", "phone")
TRAINING_SENTENCES = 900
EPOCHS = 12
RATE = 0.3
DECAY = 1e-4
MAX_TOKENS = 24
CONTEXT_TOKENS = 5
SEED = 5

Span = tuple[str, int, int]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _byte_part(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) < 4 and int(value or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; in time linear in the text: from each @ to the
    left over the local part, then the domain to the right."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the rules, by start and then kind as listed."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte_part, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# --- candidate segments and their features -----------------------------------------

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_TRIGGER = re.compile(r"[0-9]|@|[\[({<]\s?(?:at|dot)\s?[\])}>]|\bat\b[^.@\n]{1,40}\bdot\b", re.I)
_AT = r"(?:\s?@\s?|\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s)"
_DOT = r"(?:\.|\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s)"
_SHAPES = {
    "email": re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,4}}", re.I),
    "ip": re.compile(rf"[0-9]{{1,3}}(?:(?:{_DOT}|\s\.\s)[0-9]{{1,3}}){{3}}", re.I),
    "card": re.compile(r"[0-9](?:[\x20./-]?[0-9]){11,18}"),
    "phone": re.compile(r"(?:\+|\(|[0-9])[\x20().0-9/-]{5,22}[0-9]"),
}
_CUES = frozenset("tel phone call fax mobile cell mail email contact reach write ip host server address card visa pay account version section isbn order no id date build chapter".split())


def tokens_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def _separators(span: str) -> str:
    return "".join(sorted({c for c in span if not c.isalnum()}))


def features(kind: str, text: str, start: int, end: int) -> list[str]:
    """Whole-span features of text[start:end] as `kind`."""
    span = text[start:end]
    digits = _digits(span)
    before = text[max(0, start - 24) : start]
    cue = re.search(r"([A-Za-z]+)[^A-Za-z0-9]{0,3}$", before)
    out = ["bias", f"digits={len(digits)}", f"marks={_separators(span)}"]
    out.append(f"before={cue[1].lower()}" if cue and cue[1].lower() in _CUES else "before=other")
    left, right = text[start - 1 : start] if start else "", text[end : end + 1]
    out.append(f"left={'word' if left.isalnum() else left if left in '.-/+_=#$%' else 'gap'}")
    out.append(f"right={'word' if right.isalnum() else right if right in '-/+_=%' else 'gap'}")
    if kind == "card":
        out.append(f"luhn={luhn(digits)}")
    if kind == "ip":
        out.append(f"bytes={all(_byte_part(p) for p in re.findall('[0-9]+', span))}")
    if kind == "phone":
        out.append("groups=" + "-".join(str(len(g)) for g in re.findall("[0-9]+", span)[:6]))
        out.append(f"head={'digit' if span[0] in '0123456789' else span[0]}")
    if kind == "email":
        out.append(f"at={'sign' if '@' in span else 'bracket' if re.search(r'[\[({<] ?at', span, re.I) else 'word'}")
        out.append(f"dot={'bracket' if re.search(r'[\[({<] ?dot', span, re.I) else 'word' if re.search(r' dot ', span, re.I) else 'sign'}")
    return [f"{kind}:{x}" for x in out]


def candidates(text: str, spans: list[tuple[int, int]]) -> dict[int, list[tuple[int, str, list[str]]]]:
    """By end token: (start token, kind, features) of segments that have a kind's
    loose shape and at most `MAX_TOKENS` tokens."""
    starts = {a: i for i, (a, _) in enumerate(spans)}
    ends = {b: i for i, (_, b) in enumerate(spans)}
    found: dict[int, list[tuple[int, str, list[str]]]] = defaultdict(list)
    for i, (a, _) in enumerate(spans):
        first = text[a]
        if not (first.isalnum() or first in "+("):
            continue
        limit = spans[min(i + MAX_TOKENS, len(spans)) - 1][1]
        for kind, shape in _SHAPES.items():
            stop = limit
            # Also shorter segments of the same shape: the model picks the boundary.
            for _ in range(4):
                m = shape.match(text, a, stop)
                if not m or starts.get(a) != i:
                    break
                if m.end() in ends:
                    found[ends[m.end()]].append((i, kind, features(kind, text, a, m.end())))
                stop = m.end() - 1
    return found


class SegmentModel:
    """Weights of segments and of neighbouring labels ("O" is any other token)."""

    def __init__(self):
        self.weights: dict[str, float] = defaultdict(float)

    def score(self, feats: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in feats)

    def _lattice(self, n, found):
        """Per end: (start, kind, features) with the token-wise "O" among them."""
        return [[(j, "O", ["O:bias"]), *found.get(j, ())] for j in range(n)]

    def decode(self, text: str) -> list[Span]:
        """The best joint choice of boundaries and kinds."""
        spans = tokens_of(text)
        found = candidates(text, spans)
        if not found:
            return []
        best: list[dict[str, tuple[float, tuple | None]]] = [{"^": (0.0, None)}]
        for j, segments in enumerate(self._lattice(len(spans), found)):
            here: dict[str, tuple[float, tuple | None]] = {}
            for start, kind, feats in segments:
                own = self.score(feats)
                for before, (reached, _) in best[start].items():
                    total = reached + own + self.weights.get(f"{before}>{kind}", 0.0)
                    if kind not in here or total > here[kind][0]:
                        here[kind] = (total, (start, before))
            best.append(here)
        out, at = [], len(spans)
        kind = max(best[at], key=lambda k: best[at][k][0])
        while at:
            start, before = best[at][kind][1]
            if kind != "O":
                out.append((kind, spans[start][0], spans[at - 1][1]))
            at, kind = start, before
        return out[::-1]

    def gradient(self, text: str, truth: list[Span]) -> dict[str, float]:
        """Of the log-likelihood of the true segmentation: its features less the
        expected ones, by a forward and a backward pass."""
        spans = tokens_of(text)
        lattice = self._lattice(len(spans), candidates(text, spans))
        n = len(spans)
        arcs = []  # (start, end, kind, features, score)
        for j, segments in enumerate(lattice):
            arcs += [(s, j + 1, k, f, self.score(f)) for s, k, f in segments]
        ahead: list[dict[str, float]] = [defaultdict(lambda: -math.inf) for _ in range(n + 1)]
        ahead[0]["^"] = 0.0
        add = lambda a, b: a if b == -math.inf else b if a == -math.inf else max(a, b) + math.log1p(math.exp(-abs(a - b)))
        w = self.weights
        for s, e, k, _, own in arcs:
            for before, reached in list(ahead[s].items()):
                ahead[e][k] = add(ahead[e][k], reached + own + w.get(f"{before}>{k}", 0.0))
        back: list[dict[str, float]] = [defaultdict(lambda: -math.inf) for _ in range(n + 1)]
        for k in ahead[n]:
            back[n][k] = 0.0
        total = -math.inf
        for v in ahead[n].values():
            total = add(total, v)
        out: dict[str, float] = defaultdict(float)
        for s, e, k, feats, own in reversed(arcs):
            for before, reached in ahead[s].items():
                step = own + w.get(f"{before}>{k}", 0.0)
                back[s][before] = add(back[s][before], step + back[e][k])
                p = math.exp(reached + step + back[e][k] - total)
                if p > 1e-6:
                    for f in feats:
                        out[f] -= p
                    out[f"{before}>{k}"] -= p
        wanted = {(a, b): k for k, a, b in truth}
        at, before = 0, "^"
        while at < n:
            chosen = None
            for s, e, k, feats, _ in arcs:
                if s == at and (k == "O" and chosen is None or wanted.get((spans[s][0], spans[e - 1][1])) == k):
                    chosen = (e, k, feats)
                    if k != "O":
                        break
            at, k, feats = chosen
            for f in feats:
                out[f] += 1.0
            out[f"{before}>{k}"] += 1.0
            before = k
        return out


# --- training ------------------------------------------------------------------------


def _sentence(rng: random.Random) -> tuple[str, list[Span]]:
    """A made-up sentence with its true spans."""
    word = lambda: "".join(rng.choice("aeioubcdlmnrst") for _ in range(rng.randint(2, 8)))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card(ok: bool) -> str:
        while True:
            if luhn(digits := num(16)) == ok:
                return digits

    def email() -> str:
        at = rng.choice(["@", " at ", " (at) ", "[at]", " [at] ", "(at)", " AT "])
        dot = rng.choice([".", " dot ", "[dot]", " (dot) ", " DOT "]) if at != "@" else "."
        return f"{word()}{rng.choice(['', '.' + word(), num(2)])}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr'])}"

    def ip() -> str:
        return rng.choice([".", ".", "[.]", "(.)", " . ", " dot ", "[dot]"]).join(str(rng.randint(0, 255)) for _ in range(4))

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+49 {a} {b} {num(2)}", f"+{num(2)} {num(2)} {num(4)} {c}", f"{a} {b} {c}"])

    def card_text() -> str:
        digits = card(True)
        return rng.choice(["", " ", "-", ".", "/"]).join(digits[i : i + 4] for i in range(0, 16, 4))

    nothing = [
        lambda: card(False), lambda: f"{num(4)} {num(4)} {num(4)} {num(3)}", lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}", lambda: f"section {rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}",
        lambda: f"{num(3)}.{num(3)}.{num(3)}.{rng.randint(256, 999)}", lambda: f"token = \"{hashlib.sha1(num(9).encode()).hexdigest()}\"", lambda: f"{num(3)},{num(3)}",
        lambda: f"{word()} at {word()} and {word()}", lambda: f"look at the dot {word()}", lambda: f"order {num(7)}", lambda: f"{num(2)} {num(2)} {num(4)}", lambda: num(rng.randint(1, 11)),
        lambda: f"isbn {num(3)}-{num(1)}-{num(4)}-{num(4)}-{num(1)}", lambda: f"{num(4)}-{num(4)}", lambda: f"{num(2)}/{num(2)}/{num(4)}", lambda: f"build {num(3)}.{num(3)}.{num(4)}", lambda: f"@{word()}",
    ]
    cues = {"email": ["mail", "write", "contact", ""], "ip": ["host", "ip", "server", ""], "card": ["card", "visa", "pay", ""], "phone": ["tel", "call", "phone", "fax", ""]}
    text, spans = word(), []
    for _ in range(rng.randint(1, 3)):
        text += " " + " ".join(word() for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.5:
            kind = rng.choice(KINDS)
            made = {"email": email, "ip": ip, "card": card_text, "phone": phone}[kind]()
            bare = kind == "phone" and made[0] not in "+("
            cue = rng.choice([c for c in cues[kind] if c or not bare])
            text += f" {cue}{rng.choice(['', ':', ' no'])} " if cue else " "
            spans.append((kind, len(text), len(text) + len(made)))
            text += made
        else:
            text += " " + rng.choice(nothing)()
        text += rng.choice(["", ",", ".", ";"])
    return f"{text} {word()}.", spans


@functools.cache
def trained(sentences: int = TRAINING_SENTENCES, epochs: int = EPOCHS, seed: int = SEED) -> SegmentModel:
    """The model, by stochastic gradient ascent over made-up sentences."""
    rng = random.Random(seed)
    data = [_sentence(rng) for _ in range(sentences)]
    model, steps = SegmentModel(), 0
    for _ in range(epochs):
        rng.shuffle(data)
        for text, truth in data:
            steps += 1
            rate = RATE / (1 + steps / (2 * sentences))
            for f, g in model.gradient(text, truth).items():
                model.weights[f] += rate * (g - DECAY * model.weights[f])
    return model


# --- whole texts ---------------------------------------------------------------------


def _stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text around digits, @ and spelt-out signs, with some tokens of
    context, joined where they meet."""
    reach = 12 * CONTEXT_TOKENS
    found: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - reach), m.end() + reach
        if found and a <= found[-1][1]:
            found[-1][1] = max(b, found[-1][1])
        else:
            found.append([a, b])
    out = []
    for a, b in found:
        # Not in the middle of a word or number; long runs are cut where they are.
        for _ in range(64):
            if a == 0 or not text[a - 1].isalnum():
                break
            a -= 1
        for _ in range(64):
            if b >= len(text) or not text[b].isalnum():
                break
            b += 1
        out.append((a, min(b, len(text))))
    return out


def all_spans(text: str | None, model: SegmentModel) -> tuple[list[Span], list[Span]]:
    """Spans of the rules, and all spans; a null text has none."""
    if not text:
        return [], []
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for start, end in _stretches(text):
        for kind, a, b in model.decode(text[start:end]):
            a, b = a + start, b + start
            if not any(x < b and a < y for x, y in taken):
                added.append((kind, a, b))
    every = sorted({*base, *added}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return base, every


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping ones as one."""
    out, at = [], 0
    for kind, a, b in spans:
        if b <= at:
            continue
        out += [text[at : max(a, at)], f"<{kind}>" if a >= at else ""]
        at = b
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, text_col: str = "text", masked: bool = False) -> DataFrame:
    """`docs` with n_email, n_ip, n_card, n_phone (spans of the rules),
    base_spans and spans as kind:start:end lists, and with `masked` also the text
    without its personal data.

    Positions are code points, ends exclusive. A null text has no spans (its
    masked text is null). Repeated rows stay; other columns pass through, those
    named like an output are replaced.
    """
    counts = [f"n_{k}" for k in KINDS]
    made = [*counts, "base_spans", "spans", *(["masked"] if masked else [])]
    kept = [c for c in docs.columns if c not in made]
    place = kept.index(text_col)
    model = docs.sparkSession.sparkContext.broadcast(dict(trained().weights))

    def find(batches):
        own = SegmentModel()
        own.weights.update(model.value)
        for batch in batches:
            found = [(t.as_py(),) for t in batch.column(place)]
            found = [(t, *all_spans(t, own)) for (t,) in found]
            columns = [pa.array([sum(s[0] == k for s in base) for _, base, _ in found], pa.int64()) for k in KINDS]
            columns += [pa.array([joined(x[i]) for x in found], pa.string()) for i in (1, 2)]
            if masked:
                columns.append(pa.array([None if t is None else mask(t, every) for t, _, every in found], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *made])

    source = docs.select(*kept)
    added = [StructField(name, LongType() if name in counts else StringType()) for name in made]
    schema = StructType([*source.schema.fields, *added])
    return source.mapInArrow(find, schema)
