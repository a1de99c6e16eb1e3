"""Personal data in texts: exact patterns, and a semi-Markov conditional random field for other forms."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in the order of the result, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Further kinds that the random field finds, in the order of the result.
LEARNED = ("local_phone", "masked_email", "secret")
LONGEST = 14
REACH = 16
SAMPLE, WINDOWS, WINDOW_CHARS = 200, 2, 400
TURNS = 8
EXAMPLES = 8

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from the @ outwards in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1  # no match can reach over this @
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All spans of the four fixed kinds, by kind and start, in code points."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# --- the random field --------------------------------------------------------------------------

TOKEN = re.compile(r"[^\W_]+|[^\s\w]|_")
# Numbers, spelled-out dots, and assignments: of a value with a digit to any name, of anything to a telling name.
ANCHOR = re.compile(
    r"""[0-9]{2,}|[\[(<{ ][Dd][Oo][Tt][\])>} ]|\w["']?\s{0,2}[=:](?=\s{0,2}["']?[^\s"']*[0-9])"""
    r"""|(?i:passw(?:or)?d|pwd|secret|token|key)["']?\s{0,2}[=:]"""
)
KEYS = frozenset({"password", "passwd", "pwd", "secret", "token", "apikey", "key"})
LEAST_SECRET = 6
AT, DOT = frozenset({"at"}), frozenset({"dot"})
Token = tuple[str, int, int]


def _number(word: str) -> bool:
    return word.isascii() and word.isdigit()


def _tokens(text: str, start: int, end: int) -> list[Token]:
    return [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]


def _shape(words: Sequence[str]) -> str:
    """Sizes of digit groups, ``a`` for words, marks as they are; long runs shortened."""
    return "".join(str(min(len(w), 9)) if _number(w) else "a" if w.isalpha() else w for w in words)


def _class(word: str) -> str:
    return "number" if _number(word) else "word" if word[0].isalnum() else word


def _assignment(words: Sequence[str]) -> tuple[str, str, str, str] | None:
    """Name, mark, quote and value, where the words are one assignment and nothing else."""
    if not words[0][0].isalnum():
        return None
    at = 1
    while at + 1 < len(words) and words[at] in "_-" and words[at + 1][0].isalnum():
        at += 2
    if at >= len(words) - 1 or words[at] not in "=:":
        return None
    name, mark, rest = words[:at], words[at], list(words[at + 1 :])
    quote = rest[0] if rest[0] in "\"'" else ""
    if quote:
        if len(rest) < 3 or rest[-1] != quote:
            return None
        rest = rest[1:-1]
    if not all(w[0].isalnum() or w in "_-+/." for w in rest):
        return None
    return "".join(name).lower(), mark, quote, "".join(rest)


def _entropy(value: str) -> float:
    counts = np.array(list(Counter(value).values())) / len(value)
    return float(-(counts * np.log2(counts)).sum())


def _secret_features(name: str, mark: str, quote: str, value: str) -> list[str]:
    digits, letters = any(c.isdigit() for c in value), any(c.isalpha() for c in value)
    told = next((k for k in sorted(KEYS) if name.endswith(k)), "other")
    return [
        "assigned", f"named={told != 'other'},mixed={digits and letters}", f"value={digits},{letters},long={min(len(value) // 4, 8)}",
        f"entropy={min(int(2 * _entropy(value)), 8)},named={told != 'other'}", f"mark={mark},quoted={bool(quote)}",
    ]


def features(tokens: Sequence[Token], a: int, b: int) -> list[str]:
    """What the field sees of the segment ``tokens[a:b]`` as a whole, and of the word before it."""
    words = [t[0] for t in tokens[a:b]]
    lower = [w.lower() for w in words]
    digits = sum(len(w) for w in words if _number(w))
    gaps = [tokens[k + 1][1] - tokens[k][2] for k in range(a, b - 1)]
    out = ["any", f"digits={min(digits, 12)}", f"words={min(sum(w.isalpha() for w in words), 4)}", f"wide={any(g > 1 for g in gaps)}"]
    if digits and not any(w[0].isalnum() and not _number(w) for w in words):
        out.append(f"shape={_shape(words)}")
    if AT.intersection(lower) and DOT.intersection(lower):
        out.append(f"masked,ends={words[-1].isalpha() and lower[-1] not in DOT | AT},starts={words[0].isalnum() and lower[0] not in AT},dots={lower.count('dot')}")
        out.append("pattern=" + "".join(w if w in AT | DOT or not w[0].isalnum() else "w" for w in lower))
        out.append(f"tail={lower[-1]}")
    assigned = _assignment(words)
    if assigned:
        out.extend(_secret_features(*assigned))
    out.append(f"first={_class(words[0])}")
    out.append(f"last={_class(words[-1])}")
    glued_left = a > 0 and tokens[a - 1][2] == tokens[a][1]
    glued_right = b < len(tokens) and tokens[b][1] == tokens[b - 1][2] and (tokens[b][0][0].isalnum() or tokens[b][0] in "_-+/@=")
    out.append(f"glued={glued_left},{glued_right}")
    return out


def _possible(tokens: Sequence[Token], a: int, b: int) -> bool:
    """Whether a segment can be an entity at all: it must hold what an anchor marks."""
    words = [t[0] for t in tokens[a:b]]
    if words[0] in ".,;:!?)=-" or words[-1] in ".,;:!?(=-" :
        return False
    lower = {w.lower() for w in words}
    if any(len(w) > 1 and _number(w) for w in words) or (AT & lower and DOT & lower):
        return True
    assigned = _assignment(words) if len(words) > 2 else None
    return bool(assigned) and len(assigned[3]) >= LEAST_SECRET


def _ending(tokens: Sequence[Token], b: int, longest: int) -> list[tuple[int, list[str]]]:
    """Starts and features of the segments up to ``b`` that can be an entity."""
    return [(a, features(tokens, a, b)) for a in range(max(0, b - longest), b) if _possible(tokens, a, b)]


class Field:
    """Weights of a semi-Markov conditional random field; single tokens outside entities score 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None, longest: int = LONGEST):
        self.weights = weights or {}
        self.longest = longest

    def score(self, kind: str, seen: Sequence[str]) -> float:
        return sum(self.weights.get((kind, f), 0.0) for f in seen)

    def best(self, tokens: Sequence[Token]) -> list[Span]:
        """The segmentation of highest score: entities of bounded length, boundaries and kinds at once."""
        top, back = [0.0] * (len(tokens) + 1), [None] * (len(tokens) + 1)
        for b in range(1, len(tokens) + 1):
            top[b] = top[b - 1]
            for a, seen in _ending(tokens, b, self.longest):
                for kind in LEARNED:
                    value = top[a] + self.score(kind, seen)
                    if value > top[b]:
                        top[b], back[b] = value, (a, kind)
        spans, b = [], len(tokens)
        while b:
            if back[b] is None:
                b -= 1
                continue
            a, kind = back[b]
            spans.append((kind, tokens[a][1], tokens[b - 1][2]))
            b = a
        return spans[::-1]

    def learn(self, examples: Sequence[tuple[list[Token], set[tuple[int, int, str]]]], turns: int = TURNS, rate: float = 0.3) -> Field:
        """Climb the conditional likelihood of the marked segments by stochastic gradients."""
        lattices = [[_ending(tokens, b, self.longest) for b in range(len(tokens) + 1)] for tokens, _ in examples]
        for turn in range(turns):
            step = rate / (1 + 0.2 * turn)
            for (tokens, marked), lattice in zip(examples, lattices):
                n = len(tokens)
                scored = [[(a, kind, seen, self.score(kind, seen)) for a, seen in lattice[b] for kind in LEARNED] for b in range(n + 1)]
                forward = np.zeros(n + 1)
                for b in range(1, n + 1):
                    forward[b] = np.logaddexp.reduce([forward[b - 1], *(forward[a] + s for a, _, _, s in scored[b])])
                backward = np.full(n + 1, -np.inf)
                backward[n] = 0.0
                for b in range(n, 0, -1):
                    backward[b - 1] = np.logaddexp(backward[b - 1], backward[b])
                    for a, _, _, s in scored[b]:
                        backward[a] = np.logaddexp(backward[a], backward[b] + s)
                for b in range(1, n + 1):
                    for a, kind, seen, s in scored[b]:
                        want = float((a, b, kind) in marked) - float(np.exp(forward[a] + s + backward[b] - forward[n]))
                        if abs(want) > 1e-4:
                            for f in seen:
                                self.weights[kind, f] = self.weights.get((kind, f), 0.0) + step * want
        return self


def _example(before: str, entity: str, kind: str | None, after: str) -> tuple[list[Token], set[tuple[int, int, str]]]:
    text = f"{before} {entity} {after}"
    start, tokens = len(before) + 1, _tokens(f"{before} {entity} {after}", 0, len(text))
    if kind is None:
        return tokens, set()
    a = next(k for k, t in enumerate(tokens) if t[1] >= start)
    b = next(k for k, t in enumerate(tokens) if t[2] >= start + len(entity)) + 1
    return tokens, {(a, b, kind)}


def _assignments(before: str, entity: str, word: str, after: str) -> list[tuple[list[Token], set[tuple[int, int, str]]]]:
    """Secrets made of a hash of the address, in the ways they are written, and assignments that are none."""
    random = hashlib.sha256(entity.encode("utf-8", "replace")).hexdigest()
    short = re.sub("[^A-Za-z]", "", entity)[:6] + random[:4]
    letters = "".join(chr(97 + int(c, 16)) for c in random)
    values = (random[:40], random[:24], f"{letters[:12]}_{random[12:32]}", letters[:6].upper() + random[20:40])
    turn = int(random[-2:], 16)
    out = []
    for k, name in enumerate(("token", "api_key", "secret", "password", "client-secret", "pwd", "auth", "session_id")):
        value = values[(turn + k) % 4]
        telling = k < 6
        forms = (f'{name} = "{value}"', f"{name}={value}", f"{name}: {value}", f"{name}='{value}'", f'{name}: "{value}"')
        out.append(_example(before, forms[(turn + k) % 5], "secret", after))
        if telling:
            out.append(_example(before, (f"{name}={short}", f'{name} = "{short}"', f"{name}: {short}")[(turn + k) % 3], "secret", after))
    clean = (
        f"width={len(entity)}", f"{word}: {word}", f'name = "{word}"', f"time = {random[0:1]}:30", "version: 1.20.3", f"count = {turn}00", f"date: 2024-0{1 + turn % 9}-12",
        f'title="{word}"', f"step: {word}{turn}", f"total={turn}5000000", f"https://{word}", f"key: {word}", f"room: b{turn}", f"page = {turn}",
    )
    return out + [_example(before, text, None, after) for text in clean]


def training_examples(texts: Sequence[str]) -> list[tuple[list[Token], set[tuple[int, int, str]]]]:
    """Marked windows from fixed-kind spans: known data rewritten in forms the patterns miss.

    Phones lose the country code, addresses spell out ``at`` and ``dot``, hashes of addresses are assigned
    to names; the words around stay. Plain numbers and dates made from the same digits, harmless
    assignments and the unchanged surroundings are the other side.
    """
    out = []
    for text in texts:
        for kind, a, b in base_spans(text):
            entity = text[a:b]
            before = " ".join(text[max(0, a - 60) : a].split()[-5:])
            after = " ".join(text[b : b + 60].split()[:5])
            digits = re.sub("[^0-9]", "", entity)
            if kind == "phone" and len(digits) >= 10:
                d = digits[-10:]
                for form in (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"):
                    out.append(_example(before, form, "local_phone", after))
                for form in (d, d[:4], f"{d[:4]}-{d[4:6]}-{d[6:8]}", f"{d[:3]}-{d[3:6]}", f"{d[:2]}.{d[2:4]}", f"{d[:3]} {d[3:6]}"):
                    out.append(_example(before, form, None, after))
            elif kind == "email":
                name, _, domain = entity.partition("@")
                for at, dot in ((" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", " [dot] ")):
                    for own in (re.sub("[^A-Za-z0-9]", "", name), re.sub("[^A-Za-z]", "", name)):
                        out.append(_example(before, f"{own or 'x'}{at}{dot.join(domain.split('.')[-2:])}", "masked_email", after))
                out.append(_example(before, f"at {domain.split('.')[0]} and dot", None, after))
                word = next((w for w in after.split() if w.isalpha()), "now")
                out.append(_example(before, f"look at it dot {word}", None, after))
                out.extend(_assignments(before, entity, word, after))
            else:
                out.append(_example(before, digits[:5], None, after))
    return out


def learned_spans(text: str, known: Sequence[Span], field: Field, reach: int = REACH) -> list[Span]:
    """Spans of the further kinds, outside the known ones.

    Every entity holds an anchor, so only the stretches around anchors can hold one: ``reach`` words to
    both sides, cut at known spans, each solved as a whole.
    """
    taken = sorted((a, b) for _, a, b in known)
    merged: list[list[int]] = []
    for a, b in taken:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    gaps, at = [], 0
    for a, b in [*merged, [len(text), len(text)]]:
        if a > at:
            gaps.append((at, a))
        at = b
    width, out = reach * 12, []
    for low, high in gaps:
        stretch: list[list[int]] = []
        for m in ANCHOR.finditer(text, low, high):
            a, b = max(low, m.start() - width), min(high, m.end() + width)
            while a > low and not text[a - 1].isspace():
                a -= 1
            while b < high and not text[b].isspace():
                b += 1
            if stretch and a <= stretch[-1][1]:
                stretch[-1][1] = b
            else:
                stretch.append([a, b])
        for a, b in stretch:
            out.extend(field.best(_tokens(text, a, b)))
    return out


@lru_cache(maxsize=4)
def _field(items: tuple, longest: int) -> Field:
    return Field(dict(items), longest)


def fit_field(
    docs: DataFrame, text_col: str, id_col: str, sample: int = SAMPLE, turns: int = TURNS, windows: int = WINDOWS, window_chars: int = WINDOW_CHARS
) -> Field:
    """A field learned from a bounded sample: at most ``sample`` stretches around an @ or a +.

    They come from as many documents with the smallest hashes of the id, ``windows`` from each, the first
    ``window_chars`` characters of a stretch. Nothing but the fitting is bounded.
    """
    text = F.col(text_col)
    some = docs.filter(text.contains("@") | text.contains("+")).select(F.col(id_col).alias("id"), F.xxhash64(F.lit("field"), id_col).alias("h"))
    chosen = some.filter("id IS NOT NULL").orderBy("h", "id").limit(sample).select("id")
    around = F.regexp_extract_all(text, F.lit(r"((?:\S+\s+){0,5}\S*[@+]\S*(?:\s+\S+){0,8})"), F.lit(1))
    rows = docs.join(F.broadcast(chosen), docs[id_col] == chosen["id"]).select(F.explode(F.slice(around, 1, windows)).alias("w"))
    few = rows.distinct().orderBy(F.xxhash64("w"), "w").limit(sample)
    return Field().learn(training_examples([r["w"][:window_chars] for r in few.collect()])[: EXAMPLES * sample], turns)


def _finder(items: tuple, longest: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = _field(items, longest)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("learned", pa.bool_())])
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                more = learned_spans(text or "", base, field) if text else []
                order = {k: n for n, k in enumerate((*KINDS, *LEARNED))}
                both = [(k, a, b, False) for k, a, b in base] + [(k, a, b, True) for k, a, b in more]
                found.append([dict(zip(("kind", "start", "end", "learned"), s)) for s in sorted(both, key=lambda s: (order[s[0]], s[1]))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    return work


def find_personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end, learned>>`` for every row of ``docs``.

    Addresses, IP numbers, cards and phones are found by fixed patterns, leftmost and without overlap
    inside a kind. A semi-Markov random field adds spans of further kinds that overlap none of them:
    phones without country code, spelled-out addresses, and secrets after a key. It scores whole
    candidate segments of at most ``LONGEST`` words and chooses boundaries and kinds jointly by dynamic
    programming over each stretch of text that can hold one. ``field`` is fitted on a bounded sample
    of ``docs`` if none is given. Starts and ends count code points, ends are exclusive.

    Null texts count as empty and hold nothing. Repeated rows get equal spans. Empty tables give no rows,
    other columns are ignored. Work is linear in the text.
    """
    field = field or fit_field(docs, text_col, id_col)
    items = tuple(sorted((k, round(w, 6)) for k, w in field.weights.items()))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spans = "doc_id long, spans array<struct<kind:string,start:long,end:long,learned:boolean>>"
    return narrow.mapInArrow(_finder(items, field.longest), spans)


def digest(found: DataFrame) -> DataFrame:
    """Counts per fixed kind, a hash of the fixed spans, and all spans as one string."""
    base = F.filter("spans", lambda s: ~s["learned"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
