"""PII: fixed patterns, and a semi-Markov conditional random field over whole spans.

The field scores segments, not tokens: features of a whole candidate (its shape, its words, the words before and
after it) are weighed for each type, and a dynamic programme over segments of at most MOST_WORDS words chooses
boundaries and types together. Weights are trained here, by maximum likelihood on sentences made from templates.
Whole texts are decoded. What the segments from a word on score depends on the shapes and classes of the words around
it alone, so that the scores of surroundings met before are kept.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, compress
from math import exp, log
from operator import eq, itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm._text import in_batches, slices

# --- fixed patterns

# The kinds, in their order. Their patterns are written so that each place is tried once.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each sign is tried once, and its local part is read backwards from it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Places of each kind (code points, end exclusive); matches that fail a kind's condition are dropped."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    if "." in text:
        found["ip"] = [m.span() for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found["card"].append(m.span())
    if "+" in text:
        found["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


# --- the field

TYPES = ("name", "address", "birth", "iban", "ssn", "passport")
MOST_WORDS = 7
#: Words, and surroundings of words, that a decoder keeps at most.
KEPT_WORDS, KEPT_PLACES = 1 << 17, 1 << 16
EPOCHS, STEP, PENALTY, SENTENCES = 5, 0.3, 1e-4, 700
_TOKEN = re.compile(r"\w+|[^\w\s]")

# Given names, family names, streets' words, titles, cue words, months, plain words that begin sentences or
# stand in names of things, and words of places and bodies.
GIVEN = "john mary james anna peter laura robert julia thomas sarah michael emma david sophie daniel maria paul claire lukas hannah pierre marie jean juan carlos carmen jose lucia hans ursula stefan".split()
FAMILY = "smith johnson miller brown davis wilson moore taylor anderson martin garcia lopez perez fernandez mueller schmidt weber fischer becker dubois moreau laurent bernard lefevre rossi novak larsen jensen".split()
STREET = "street st avenue ave road rd lane ln drive boulevard blvd court square way strasse straße gasse rue calle plaza".split()
TITLES = "mr mrs ms dr prof herr frau monsieur madame señor señora".split()
CUES = (
    "name named names contact contacted call called born birth birthday dob address lives lived living residing iban account ssn social security passport signed signature patient customer client employee "
    "regards sincerely faithfully dear hello hi attn met meet said says told asked wrote writes replied works by from for with and geboren anschrift né née nacido llamado llama heißt appelle"
).split()
MONTHS = "january february march april may june july august september october november december".split()
PLAIN = (
    "the a an of to in is was on that this these those at are be it we you they he she i his her its our their who what when where why how but not no yes if so then there here all any some each most "
    "new great good first last next old big der die das und ein eine ist le la les un une est el los las una es please thanks thank see note page chapter section table figure number part monday tuesday wednesday thursday friday saturday sunday"
).split()
PLACES = (
    "city state states united union european kingdom republic university college school office department ministry bank company corporation corp inc ltd gmbh museum hotel airport station river lake mountain park "
    "committee council commission association institute agency museum london paris berlin madrid york europe africa asia america germany france spain england india china japan"
).split()
_OTHER = "the a of and to in is was for with on that this by from at are be it we you they report meeting price order table result city house water light music season paper number page".split()


def _shape(word: str) -> str:
    if word.isdigit():
        return f"d{min(len(word), 5)}"
    if word.isalpha():
        return "A" if word.isupper() else "Aa" if word[0].isupper() else "a"
    return word if len(word) == 1 else f"mix{min(len(word), 12)}"


def _class(low: str) -> str:
    return _KINDS_OF.get(low, "")


def _beside(kind: str, shape: str) -> str:
    """What a segment sees of a word beside it: its class, or else whether it is capitalised or a number."""
    return kind or ("~A" if shape in ("A", "Aa") else "~d" if shape[0] == "d" and shape[1:] else "")


#: The class of each listed word, of several lists the last one's here; a cue word is its own.
_KINDS_OF = {word: name or word for name, words in (("", CUES), ("place", PLACES), ("plain", PLAIN), ("month", MONTHS), ("title", TITLES), ("street", STREET), ("family", FAMILY), ("given", GIVEN)) for word in words}


#: The class of a word that says the word before it again.
SAME = "same"


def _classes(words: list[str]) -> list[str]:
    return [SAME if i and w == words[i - 1] else _class(w.lower()) for i, w in enumerate(words)]


def _segment(words: list[str], kinds: list[str], i: int, j: int) -> tuple[str, ...]:
    """Features of the whole segment of words i .. j - 1, of words with their classes."""
    shapes = [_shape(w) for w in words[i:j]]
    classes = kinds[i:j]
    digits = sum(len(w) for w in words[i:j] if w.isdigit())
    out = [f"n{j - i}", "s" + " ".join(shapes), "c" + " ".join(classes), f"d{min(digits, 24)}", f"l{_beside(kinds[i - 1], _shape(words[i - 1])) if i else '^'}", f"r{_beside(kinds[j], _shape(words[j])) if j < len(kinds) else '$'}", f"f{shapes[0]}", f"e{shapes[-1]}"]
    if i > 1:
        out.append(f"k{kinds[i - 2]}")
    out += {f"h{c}" for c in classes if c}
    return tuple(out)


def _candidate(words: list[str], i: int, j: int) -> bool:
    """Whether an entity can span these words: it has a capital or a digit at its start and more than signs."""
    first, last = words[i], words[j - 1]
    return (first[0].isupper() or first[0].isdigit()) and (last[0].isalnum())


Weights = dict[tuple[int, str], float]


def _scores(words: list[str], kinds: list[str], weights: Weights) -> dict[tuple[int, int], list[float]]:
    """Score of each type for each candidate segment."""
    found = {}
    for i in range(len(words)):
        for j in range(i + 1, min(i + MOST_WORDS, len(words)) + 1):
            if _candidate(words, i, j):
                features = _segment(words, kinds, i, j)
                found[i, j] = [sum(weights.get((t, f), 0.0) for f in features) for t in range(len(TYPES))]
    return found


def _add(a: float, b: float) -> float:
    return a + log(1 + exp(b - a)) if a >= b else b + log(1 + exp(a - b))


def _gradient(words: list[str], gold: dict[tuple[int, int], int], weights: Weights) -> dict[tuple[int, str], float]:
    """Features of the right segments less their expectation: forwards and backwards over segments."""
    kinds = _classes(words)
    scores, n = _scores(words, kinds, weights), len(words)
    ending, starting = defaultdict(list), defaultdict(list)
    for (i, j), own in scores.items():
        ending[j].append((i, own))
        starting[i].append((j, own))
    ahead, back = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        ahead[j] = ahead[j - 1]  # a word outside all entities
        for i, own in ending[j]:
            for s in own:
                ahead[j] = _add(ahead[j], ahead[i] + s)
    for i in range(n - 1, -1, -1):
        back[i] = back[i + 1]
        for j, own in starting[i]:
            for s in own:
                back[i] = _add(back[i], s + back[j])
    out: dict[tuple[int, str], float] = defaultdict(float)
    for (i, j), own in scores.items():
        features = None
        for t, s in enumerate(own):
            change = (gold.get((i, j)) == t) - exp(ahead[i] + s + back[j] - ahead[n])
            if abs(change) > 1e-3:
                features = features or _segment(words, kinds, i, j)
                for f in features:
                    out[t, f] += change
    return out


def sentences(n: int = SENTENCES, seed: int = 5) -> list[tuple[list[str], dict[tuple[int, int], int]]]:
    """Labelled sentences from templates: words, and the type of each entity's segment."""
    rng, out = random.Random(seed), []
    number = lambda k: "".join(rng.choices("0123456789", k=k))
    title = lambda x: x[0].upper() + x[1:]

    def unknown() -> str:
        """A capitalised word of no list."""
        return title("".join(rng.choice("bcdfghjklmnprstvwyz") + rng.choice(("a", "e", "i", "o", "u", "ai", "ee", "an", "in", "or")) for _ in range(rng.randint(2, 4))))

    def name() -> str:
        # Half of the names are of no list, so that their surroundings are learned too.
        parts = [title(rng.choice(GIVEN)), title(rng.choice(FAMILY))] if rng.random() < 0.5 else [unknown(), unknown()]
        if rng.random() < 0.1:
            parts.insert(1, unknown())
        if rng.random() < 0.1:
            parts = [p.upper() for p in parts]
        if rng.random() < 0.2:
            return " ".join([title(rng.choice(TITLES)) + ".", *parts[rng.randint(0, 1) :]])
        return " ".join(parts)

    def date() -> str:
        d, m, y = rng.randint(1, 28), rng.randint(1, 12), rng.randint(1930, 2010)
        return rng.choice([f"{d:02}/{m:02}/{y}", f"{y}-{m:02}-{d:02}", f"{d}.{m}.{y}", f"{d} {title(MONTHS[m - 1])} {y}", f"{title(MONTHS[m - 1])} {d}, {y}"])

    def address() -> str:
        street = title(rng.choice(FAMILY)) if rng.random() < 0.5 else unknown()
        return rng.choice([f"{rng.randint(1, 999)} {street} {title(rng.choice(STREET[:13]))}", f"{street} {title(rng.choice(STREET[13:17]))} {rng.randint(1, 200)}", f"{rng.randint(1, 99)} {title(rng.choice(STREET[17:]))} {street}"])

    def iban() -> str:
        groups = [number(4) for _ in range(rng.randint(3, 5))] + ([number(rng.randint(1, 3))] if rng.random() < 0.6 else [])
        return " ".join([rng.choice(["DE", "FR", "ES", "GB", "BE", "IT"]) + number(2), *groups])

    makers = {
        "name": (name, [
            "name : {}", "contact {} for", "Contact {} at", "patient {} was", "The patient {} was", "signed , {}", "customer {}", "regards , {}", "Sincerely , {}", "we met {} at the", "{} lives in", "{} said that", "{} wrote to us", "called {} .",
            "Call {} or", "Dear {} ,", "told {} that", "my name is {} and", "asked {} about", "{} works for the", "signed by {} on", "employee {} (", "Hello {} !", "the client , {} ,", "Regards {}", "{} told us that",
        ]),
        "birth": (date, ["born on {}", "date of birth : {}", "dob {}", "geboren am {}", "birthday : {}"]),
        "address": (address, ["address : {}", "lives at {}", "residing at {} in", "we went to {} with", "I live at {} ."]),
        "iban": (iban, ["iban {}", "account {}", "pay to iban : {}", "IBAN {} ."]),
        "ssn": (lambda: f"{number(3)}-{number(2)}-{number(4)}", ["ssn {}", "social security number {}", "social security : {}"]),
        "passport": (lambda: rng.choice("ABCDEFGHKLMNPR") + number(8), ["passport {}", "passport number : {}", "passport no . {}", "Passport No : {}"]),
    }
    plain = [
        "{w} {d} {w}", "on {date} the {w}", "{W} {w} {w} . {W}", "{w} {d} , {d} {w}", "page {d} of {d}", "{W} {W} {w}", "price {d} . {d} {w}", "number {d} - {d} - {d}", "account {w} {w}", "the name of the {W} {w}",
        "went to the {U} {U} {w}", "in {U} {U} ,", "the {U} {U} agreed", "The {U} {U} is a {w}", "{U} {U} is a {w} of", "{U} {w} {w} .", ". {U} {U} {U} ,", "from {U} to {U}", "the {P} of {U}", "{P} {P} and the {U} {P}", "in {U} and {U} the {w}",
        "The {w} was {w} .", "Dear {w} ,", "contact the {U} {P}", "called the {U} {P}", "{U} {U} {w} {w}", "for the {U} {w}", "by the {P} of {U} {U}", "Passport No", "with {U} {w}", "Monday in {U}", "the {w} by the {w}", "Call the {w}", ". The {U} {w}",
        "order {d} - {d} - {d}", "{U} , {U} , {U}", "\u201c {U} {w} {U} \u201d", "See {U} {d} .", "{A} {A} {w}",
        "{R}", "{R}", "{w} . {U} . {U} for {w}", "{U} . {U} {w}", "went to the {U} {U} for {w}", "we {U} {U} {w}", "{w} {N} {w}", "{N} {w} , {N}", "token = {H} .", "{H} {w} {H}", "{U} {U} {U} {U} {U}", "{U} {U} {U} {U} {w}",
    ]
    fill = {"w": lambda: rng.choice(_OTHER), "W": lambda: title(rng.choice(_OTHER)), "d": lambda: number(rng.randint(1, 4)), "date": date, "U": unknown, "P": lambda: title(rng.choice(PLACES)), "A": lambda: unknown().upper(), "R": lambda: " ".join([title(rng.choice([rng.choice(PLAIN), rng.choice(CUES), unknown()]))] * rng.randint(3, 8)),
            "N": lambda: number(rng.randint(9, 18)), "H": lambda: "".join(rng.choices("0123456789abcdef", k=rng.randint(12, 40)))}
    for _ in range(n):
        words: list[str] = []
        gold: dict[tuple[int, int], int] = {}
        for _ in range(rng.randint(1, 3)):
            words += rng.choices(_OTHER, k=rng.randint(0, 4)) + (["."] if rng.random() < 0.3 else [])
            if rng.random() < 0.5:
                kind = "name" if rng.random() < 0.4 else rng.choice(TYPES)
                make, templates = makers[kind]
                before, after = rng.choice(templates).split("{}")
                words += _TOKEN.findall(before)
                own = _TOKEN.findall(make())
                gold[len(words), len(words) + len(own)] = TYPES.index(kind)
                words += own + _TOKEN.findall(after)
            else:
                words += _TOKEN.findall(re.sub(r"\{(\w+)\}", lambda m: fill[m[1]](), rng.choice(plain)))
        out.append((words, {k: v for k, v in gold.items() if k[1] - k[0] <= MOST_WORDS}))
    return out


def train(labelled: list[tuple[list[str], dict[tuple[int, int], int]]], epochs: int = EPOCHS) -> Weights:
    """Weights by AdaGrad steps on the likelihood, sentence by sentence."""
    weights: Weights = {}
    sums: dict[tuple[int, str], float] = defaultdict(float)
    for _ in range(epochs):
        for words, gold in labelled:
            for key, g in _gradient(words, gold, weights).items():
                g -= PENALTY * weights.get(key, 0.0)
                sums[key] += g * g
                weights[key] = weights.get(key, 0.0) + STEP * g / (sums[key] ** 0.5 + 1e-6)
    return weights


@lru_cache(maxsize=1)
def model() -> tuple[tuple[tuple[int, str], float], ...]:
    """The built-in weights; the same in every process."""
    return tuple((k, round(w, 4)) for k, w in sorted(train(sentences()).items()) if abs(w) > 0.01)


def _decode(words: list[str], weights: Weights) -> list[tuple[int, int, int]]:
    """The best segmentation: entities (first word, end, type), none overlapping."""
    ending = defaultdict(list)
    for (i, j), own in _scores(words, _classes(words), weights).items():
        t = max(range(len(own)), key=own.__getitem__)
        if own[t] > 0:
            ending[j].append((i, t, own[t]))
    best, via = [0.0] * (len(words) + 1), [None] * (len(words) + 1)
    for j in range(1, len(words) + 1):
        best[j] = best[j - 1]
        for i, t, s in ending[j]:
            if best[i] + s > best[j]:
                best[j], via[j] = best[i] + s, (i, t)
    out, j = [], len(words)
    while j:
        if via[j]:
            out.append((via[j][0], j, via[j][1]))
            j = via[j][0]
        else:
            j -= 1
    return out[::-1]


#: What features take from words: those before and after a text, and a word of small letters in no list.
_BEFORE, _AFTER = (False, False, "", None, 0, "^"), (False, False, "", None, 0, "$")
_COMMON = (False, True, "a", "", 0, "")


class Decoder:
    """Chooses the segments of whole texts as _decode does, by scores kept for surroundings met before."""

    def __init__(self, weights: Weights) -> None:
        self.weights = weights
        self.vectors: dict[str, list[float]] = {}
        for (t, feature), w in weights.items():
            self.vectors.setdefault(feature, [0.0] * len(TYPES))[t] = w
        self.codes: dict[str, tuple] = {}
        self.again: dict[str, tuple] = {}
        self.shared: dict[tuple, tuple] = {}
        self.places: dict[tuple, list[tuple[int, int, float]]] = {}

    def code(self, word: str, again: bool) -> tuple:
        """All that features take from a word, after whether an entity can start or end with it; again: it is the word before it, too."""
        kept = self.again if again else self.codes
        kind = SAME if again else _class(word.lower())
        if not kind and word.islower() and word.isalpha():
            code = _COMMON
        else:
            shape = _shape(word)
            code = (word[0].isupper() or word[0].isdigit(), word[0].isalnum(), shape, kind, min(len(word), 24) if word.isdigit() else 0, _beside(kind, shape))
        if len(kept) >= KEPT_WORDS:
            kept.clear()
        if len(self.shared) >= KEPT_WORDS:
            self.shared.clear()
            self.places.clear()
        code = kept[word] = self.shared.setdefault(code, code)
        return code

    def segments(self, place: tuple) -> list[tuple[int, int, float]]:
        """(words, type, score) of the segments from a place on that score above 0.

        A place is the class of the word but one before it, what is seen of the word before, the words from it on that a
        segment can have, and what is seen of the word after these.
        """
        vectors = self.vectors
        base = [0.0] * len(TYPES)
        for feature in (f"l{place[1]}", f"f{place[2][2]}", *([f"k{place[0]}"] if place[0] is not None else [])):
            if v := vectors.get(feature):
                base = [x + y for x, y in zip(base, v, strict=True)]
        out, shapes, classes, digits, met = [], "s", "c", 0, set()
        for size in range(1, MOST_WORDS + 1):
            word = place[1 + size]
            if word is _AFTER:
                break
            shapes, classes = (shapes + word[2], classes + word[3]) if size == 1 else (f"{shapes} {word[2]}", f"{classes} {word[3]}")
            digits += word[4]
            if word[3] and word[3] not in met:
                met.add(word[3])
                if v := vectors.get(f"h{word[3]}"):
                    base = [x + y for x, y in zip(base, v, strict=True)]
            if word[1]:
                after, own = place[-1] if size == MOST_WORDS else place[2 + size][5], base
                for feature in (f"n{size}", shapes, classes, f"d{min(digits, 24)}", f"r{after}", f"e{word[2]}"):
                    if v := vectors.get(feature):
                        own = [x + y for x, y in zip(own, v, strict=True)]
                best = max(own)
                if best > 0:
                    out.append((size, own.index(best), best))
        if len(self.places) >= KEPT_PLACES:
            self.places.clear()
        self.places[place] = out
        return out

    def decode(self, words: list[str]) -> list[tuple[int, int, int]]:
        """The best segmentation: entities (first word, end, type), none overlapping."""
        known, again, places = self.codes, self.again, self.places
        own = list(map(known.get, words))
        if not all(own):
            own = [code or known.get(w) or self.code(w, False) for w, code in zip(words, own, strict=True)]
        for i in compress(range(1, len(words)), map(eq, words[1:], words)):
            own[i] = again.get(words[i]) or self.code(words[i], True)
        starts = compress(range(len(words)), map(itemgetter(0), own))
        codes = [_BEFORE, _BEFORE, *own, *[_AFTER] * (MOST_WORDS + 1)]
        out: list[tuple[int, int, int]] = []
        held: list[tuple[int, int, int, float]] = []  # segments that overlap, one after another
        end = 0
        for i in starts:
            place = (codes[i][3], codes[i + 1][5], *codes[i + 2 : i + 2 + MOST_WORDS], codes[i + 2 + MOST_WORDS][5])
            found = places.get(place)
            if found is None:
                found = self.segments(place)
            for size, t, score in found:
                if held and i >= end:
                    out += _chosen(held)
                    held = []
                held.append((i, i + size, t, score))
                end = max(end, i + size)
        return out + _chosen(held)


def _chosen(held: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Of segments (first word, end, type, score), in order, those of the best total that do not overlap."""
    if len(held) < 2:
        return [x[:3] for x in held]
    low, ending = held[0][0], defaultdict(list)
    for i, j, t, score in held:
        ending[j].append((i, t, score))
    n = max(ending) - low
    best, via = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i, t, score in ending.get(j + low, ()):
            if best[i - low] + score > best[j]:
                best[j], via[j] = best[i - low] + score, (i, t)
    out, j = [], n
    while j:
        if via[j]:
            out.append((via[j][0], j + low, via[j][1]))
            j = via[j][0] - low
        else:
            j -= 1
    return out[::-1]


_DECODER: list[Decoder] = []


def field_spans(text: str, weights: Weights) -> list[tuple[int, int, str]]:
    """Entities of the field over the whole text: (start, end, type), by start."""
    if not _DECODER or _DECODER[0].weights is not weights:
        _DECODER[:] = [Decoder(weights)]
    found = _DECODER[0].decode(_TOKEN.findall(text))
    if not found:
        return []
    places = [m.span() for m in _TOKEN.finditer(text)]
    return [(places[i][0], places[j - 1][1], TYPES[t]) for i, j, t in found]


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(text: str | None, weights: Weights) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[int, int, str]]]:
    """The fixed kinds' places, and the field's entities that overlap none of them."""
    base = base_spans(text or "")
    taken = sorted(x for spans in base.values() for x in spans)
    field = field_spans(text or "", weights)
    if taken and field:
        # Of the places that begin before an entity's end, the one that reaches furthest.
        starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
        field = [(a, b, t) for a, b, t in field if not (n := bisect_left(starts, b)) or reach[n - 1] <= a]
    return base, field


SCAN = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def scan(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Places are code points, end exclusive, listed by kind (the fixed ones, then the field's types), then start. Null
    and empty texts have none. Repeated rows each get a row; other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    known = weights or dict(model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = []
            for text in part.column(1).to_pylist():
                base, field = find(text, known)
                own = [(k, a, b) for k in KINDS for a, b in base[k]]
                more = sorted(((t, a, b) for a, b, t in field), key=lambda x: (TYPES.index(x[0]), x[1]))
                rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(_listed(own).encode()).hexdigest(), _listed(own + more)))
            columns = list(zip(*rows, strict=True))
            yield pa.record_batch([part.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCAN)


def redact(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """docs with each place replaced by its kind in brackets, overlapping ones by the first; columns stay as they are, n_chars is counted anew where text went.

    Null and empty texts and those without places stay as they are. Repeated rows and rows without id each stay; an empty
    table stays empty.
    """
    known = weights or dict(model())
    at, count = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts, changed = part.column(at).to_pylist(), set()
            for k, text in enumerate(texts):
                base, field = find(text, known)
                spans = sorted([(a, b, kind) for kind in KINDS for a, b in base[kind]] + field)
                if spans:
                    out, last = [], 0
                    for a, b, kind in spans:
                        if a >= last:
                            out += [text[last:a], f"[{kind.upper()}]"]
                        last = max(last, b)
                    texts[k] = "".join([*out, text[last:]])
                    changed.add(k)
            if changed:
                part = part.set_column(at, part.schema.field(at), pa.array(texts, part.column(at).type))
                if count is not None:
                    counts = [len(texts[k]) if k in changed else n for k, n in enumerate(part.column(count).to_pylist())]
                    part = part.set_column(count, part.schema.field(count), pa.array(counts, part.column(count).type))
            yield part

    return in_batches(docs).mapInArrow(run, docs.schema)
