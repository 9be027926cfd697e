"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is an assigned value of at least eight characters (`name = value`, `name: value`, quoted or not; one of
letters only where the name says it is a secret), the password of a URL (`scheme://user:password@`), any
run of at least sixteen characters of the alphabets keys are written in that has a letter and a digit, or the body
marker of a private key. Each gets the features of its own characters (length, classes, entropy, how
usual its character transitions are in the corpus's words, how much of it the corpus's words cover, how much of it are
pieces of one kind as in identifiers) and of its
surroundings (path or URL, quotes, assignment, words before it that name secrets or harmless identifiers).

The forest is trained from labelled findings: a frame of (before, value, after, secret), by default
`labelled_findings`, which sets known key formats and known harmless formats among words of the corpus, keys with and
without a secret's name before them, harmless values likewise, so that neither the name nor the format decides alone; the
corpus's own findings are never trained on. A word is a run of 2 to 24 letters; words and character pairs are counted
over all texts. The scorer holds all pairs of Latin letters (below U+0250, fewer than 600) and of the words and other pairs
those with at least one in `WORDS` of all occurrences, so never more than `WORDS` of each.

Values that are no secret, and values that hold a URL, are looked at again inside: `name=value` and `name:value` in
them, the latter up to the next separator, and runs. If one of those is a secret, they take the place of the whole value.

Defined results: a null text has no findings; overlapping candidates give the assigned one; rows that repeat are each
scanned; an empty table has no findings. Offsets count characters.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Steps, read

WORDS, FINDINGS, SEED, LATIN = 500_000, 6_000, 11, 0x250
TREES, DEPTH, LEAF, BINS, LEAST = 60, 9, 4, 16, 0.5
MASK = "[SECRET]"

RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")  # "=" only pads: before a value it assigns
ASSIGNED = re.compile(r"[=:][ \t]{0,3}[\"']?([^\s\"'&,;<>()\[\]{}|]{7,}[^\s\"'&,;<>()\[\]{}|.])")  # a dot at the end is the sentence's
#: Assigned inside a value: after "=" up to the next "=" or the "?" of a query, after ":" up to the next ":" too; padding at the end belongs to it.
INSIDE = re.compile(r"=((?:[^=?]|\?(?![\w.-]{1,40}=)){8,}(?:={1,2}\Z)?)|:((?:[^=:?]|\?(?![\w.-]{1,40}=)){8,}(?:={1,2}\Z)?)")
#: The password of a URL.
CREDENTIAL = re.compile(r"//[^\s:/@\"']{0,80}:([^\s:/@\"']{4,})@")
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
DAY = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
NAME = re.compile(r"([A-Za-z][\w.-]{0,40})[\"']?[ \t]{0,3}$")
# fixed values: words that name secrets, and words that name harmless identifiers
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "auth", "credential", "bearer", "private", "access")
HARMLESS_WORDS = ("sha", "sha1", "sha256", "md5", "commit", "hash", "checksum", "digest", "uuid", "guid", "id", "version", "example", "url", "href", "src", "path", "etag")
BEFORE, AFTER = 60, 20


def _assignable(value: str) -> bool:
    return not value.startswith("//") and not value.isalpha() and re.search(r"[A-Za-z]", value) is not None


def _names_a_secret(before: str) -> bool:
    name = NAME.search(before)
    return name is not None and any(w in name.group(1).lower() for w in SECRET_WORDS)


def _runs(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in RUN.finditer(text, start, end) if any(c.isdigit() for c in m.group()) and any(c.isalpha() for c in m.group())]


def _outermost(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    kept, end = [], 0
    for a, b in sorted(found, key=lambda s: (s[0], -s[1])):
        if a >= end:
            kept.append((a, b))
            end = b
    return kept


def _assigned_inside(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Values assigned inside text[start:end]; an end of the slice is an end of the value."""
    spans = [(start + m.start(m.lastindex), start + m.end(m.lastindex)) for m in INSIDE.finditer(text[start:end])]
    passwords = [m.span(1) for m in CREDENTIAL.finditer(text, start, end)]
    return passwords + [(a, b) for a, b in spans if _assignable(text[a:b]) and not any(a < d and c < b for c, d in passwords)]


def candidates_inside(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Start and end of each smaller candidate in the value text[start:end], in order, none overlapping."""
    found = _assigned_inside(text, start, end) + _runs(text, start, end)
    return _outermost([s for s in found if s != (start, end)])


def candidates(text: str) -> list[tuple[int, int]]:
    """Start and end of each candidate, in order, none overlapping."""
    found = [(m.start(), m.end()) for m in KEY_BLOCK.finditer(text)] if "PRIVATE KEY" in text else []
    for m in ASSIGNED.finditer(text):
        if _assignable(m.group(1)):
            found.append(m.span(1))
        elif m.group(1).isalpha() and _names_a_secret(text[max(0, m.start() - 45):m.start()]):
            found.append(m.span(1))
        elif m.group(1).startswith("//"):
            found += _assigned_inside(text, *m.span(1))
    return _outermost(found + _runs(text, 0, len(text)))


class Language:
    """What is usual in the corpus: its words, and how often one character follows another inside them."""

    def __init__(self, words: list[str], pairs: dict | None = None, firsts: dict | None = None):
        if pairs is None or firsts is None:  # counted in the words given
            pairs = Counter(p for w in words for p in zip(w, w[1:]))
            firsts = Counter(c for w in words for c in w[:-1])
        self.follow = {p: math.log2((n + 1) / (firsts[p[0]] + 64)) for p, n in pairs.items()}
        self.words = {w for w in words if len(w) >= 4}
        self.longest = max(map(len, self.words), default=0)

    def transitions(self, value: str) -> float:
        pairs = list(zip(value.lower(), value.lower()[1:]))
        return sum(self.follow.get(p, -9.0) for p in pairs) / max(len(pairs), 1)

    def letters(self, value: str) -> float:
        """Transitions between letters only; as usual as can be where there are none."""
        known = [self.follow.get(p, -9.0) for p in zip(value.lower(), value.lower()[1:]) if p[0].isalpha() and p[1].isalpha()]
        return sum(known) / len(known) if known else 0.0

    def covered(self, value: str) -> float:
        low, at, n = value.lower(), 0, 0
        while at < len(low):
            size = next((k for k in range(min(self.longest, len(low) - at), 3, -1) if low[at:at + k] in self.words), 0)
            n, at = n + size, at + max(size, 1)
        return n / max(len(low), 1)


def pieces(value: str) -> tuple[float, float]:
    """Share of the characters in pieces of one kind (digits, or letters in one case or with a capital), and length of the longest other piece."""
    parts = re.findall(r"[^\W_]+", value)
    plain = [p for p in parts if len(p) > 1 and (p.isdigit() or p.isalpha() and (p.islower() or p.isupper() or p.istitle()))]
    mixed = [len(p) for p in parts if not (p.isdigit() or re.fullmatch(r"[a-z]*(?:[A-Z][a-z]+)*[0-9]*|[A-Z]+[0-9]{0,4}", p))]
    return sum(map(len, plain)) / max(sum(map(len, parts)), 1), float(max(mixed, default=0))


def features(language: Language, before: str, value: str, after: str) -> list[float]:
    size = max(len(value), 1)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in value]
    share = Counter(value.lower())
    entropy = -sum(n / size * math.log2(n / size) for n in share.values())
    kind = Counter(kinds)
    name = NAME.search(re.sub(r"[\"'=: \t]+$", "", before))
    named = name.group(1).lower() if name else ""
    parts = set(re.split(r"[^a-z0-9]+", named)) | {named}
    nearby = set(re.findall(r"[a-z0-9_]+", before.lower()))
    left = before.rstrip("\"' \t")
    return [
        math.log(size), kind["d"] / size, kind["u"] / size, kind["l"] / size, kind["s"] / size, entropy, len(share) / size,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / size, language.transitions(value), language.covered(value),
        float(all(c in "0123456789abcdefABCDEF" for c in value)), float(size in (32, 40, 64, 36)), max(share.values(), default=0) / size,
        float("/" in value or "." in value), float(before[-1:] in ("/", "@", "?", "#", ".") or after[:1] in ("/", "@")), float("://" in before[-40:] or "www." in before[-40:]),
        float(before[-1:] in ("'", '"')), float(left[-1:] in ("=", ":")), float(any(p in SECRET_WORDS for p in parts)),
        float(any(w in named for w in SECRET_WORDS)), float(any(p in HARMLESS_WORDS for p in parts)),
        float(bool(nearby & set(SECRET_WORDS))), float(bool(nearby & set(HARMLESS_WORDS))), float(value.startswith("-----BEGIN")),
        *pieces(value), language.letters(value), float(before[-1:] == ":" and after[:1] == "@"), float(DAY.match(value) is not None), float(UUID.fullmatch(value) is not None),
    ]


class Forest:
    """Trees on bootstrap samples with a random third of the features at each split; thresholds are quantiles."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED):
        self.trees, draw = [], np.random.default_rng(seed)
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        for _ in range(TREES):
            rows = draw.integers(0, len(x), len(x))
            self.trees.append(self._grow(x[rows], y[rows], cuts, draw, DEPTH))

    def _grow(self, x, y, cuts, draw, depth):
        share = float(y.mean())
        if depth == 0 or len(y) < 2 * LEAF or share in (0.0, 1.0):
            return share
        best = (share * (1 - share) * len(y) - 1e-9, None, None)
        for j in draw.choice(x.shape[1], max(1, x.shape[1] // 3), replace=False):
            for cut in cuts[j]:
                low = x[:, j] <= cut
                n = int(low.sum())
                if LEAF <= n <= len(y) - LEAF:
                    a, b = y[low].mean(), y[~low].mean()
                    impurity = a * (1 - a) * n + b * (1 - b) * (len(y) - n)
                    if impurity < best[0]:
                        best = (impurity, j, cut)
        if best[1] is None:
            return share
        low = x[:, best[1]] <= best[2]
        return (best[1], best[2], self._grow(x[low], y[low], cuts, draw, depth - 1), self._grow(x[~low], y[~low], cuts, draw, depth - 1))

    def score(self, row: list[float]) -> float:
        total = 0.0
        for tree in self.trees:
            while isinstance(tree, tuple):
                tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
            total += tree
        return total / len(self.trees)


def corpus_statistics(docs: DataFrame, most: int = WORDS, whole_below: int = 0) -> tuple[list[str], dict[tuple[str, str], int], dict[str, int]]:
    """Words of letters (most frequent first), pairs of characters in them, and first characters of pairs with their counts.

    All rows count. Pairs of characters below ``whole_below`` are all returned; of words and of other pairs those that have at least one in
    ``most`` of all occurrences, which no more than ``most`` can have; first characters are no more than there are letters.
    """
    steps = Steps(docs.sparkSession, "secrets")
    each = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(r"(?<![\p{L}\p{N}])\p{L}{2,24}(?![\p{L}\p{N}])"), F.lit(0))).alias("w"))
    words = steps.keep(each.groupBy("w").agg(F.count("*").alias("n")), "words")
    inside = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring(F.col("w"), i, F.lit(2)))
    pairs = steps.keep(words.select(F.explode(inside).alias("p"), "n").groupBy("p").agg(F.sum("n").alias("n")), "pairs")

    def frequent(counted: DataFrame, name: str, always: Column = F.lit(False)):
        total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        table = counted.where((F.col("n") * most >= total) | always).select(name, "n").toArrow()
        return sorted(zip(table.column(0).to_pylist(), table.column(1).to_pylist()), key=lambda x: (-x[1], x[0]))

    whole = (F.ascii("p") < whole_below) & (F.ascii(F.substring("p", 2, 1)) < whole_below)
    firsts = pairs.groupBy(F.substring("p", 1, 1).alias("c")).agg(F.sum("n").alias("n"))
    found = [w for w, _ in frequent(words, "w")], {(p[0], p[1]): n for p, n in frequent(pairs, "p", whole)}, {r["c"]: r["n"] for r in firsts.collect()}
    steps.drop("words", "pairs")
    return found


def made_up_words(language: Language, n: int, draw: np.random.Generator) -> list[str]:
    """Words that the corpus does not have, from its character transitions."""
    after: dict[str, list[tuple[str, float]]] = {}
    for (one, two), weight in sorted(language.follow.items()):
        if one.isascii() and two.isascii():
            after.setdefault(one, []).append((two, 2.0**weight))
    starts, out = sorted(after), []
    for _ in range(n if starts else 0):
        word = starts[int(draw.integers(len(starts)))]
        for _ in range(int(draw.integers(2, 8))):
            if word[-1] not in after:
                break
            letters, weights = zip(*after[word[-1]])
            word += letters[int(np.searchsorted(np.cumsum(weights), draw.random() * sum(weights)).clip(0, len(letters) - 1))]
        out.append(word)
    return out


def findings_by_kind(words: list[str], language: Language, draw: np.random.Generator) -> dict[str, tuple[int, object]]:
    """For each kind of finding: whether it is a secret, and a function that draws one as (before, value, after)."""
    words = [w for w in words if w.isascii()] or ["the", "and", "value", "with", "from", "this"]
    known, made = words[:20_000], made_up_words(language, 2_000, draw) or words
    pick = lambda options: options[int(draw.integers(len(options)))]
    word = lambda: pick(known) if draw.random() < 0.5 else pick(made)
    chars = lambda alphabet, k: "".join(alphabet[i] for i in draw.integers(0, len(alphabet), k))
    prose = lambda k: " ".join(pick(known) for _ in range(k))
    snake = lambda mark, least=2, most=5: mark.join(word() for _ in range(int(draw.integers(least, most))))
    digits, hexa, lower, upper = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    base = lower + upper + digits
    # fixed values: formats of well-known keys
    keys = {
        "aws": lambda: pick(["AKIA", "ASIA"]) + chars(upper + digits, 16), "github": lambda: pick(["ghp_", "gho_", "ghs_"]) + chars(base, 36),
        "stripe": lambda: pick(["sk_live_", "rk_live_", "sk_test_"]) + chars(base, 24), "slack": lambda: pick(["xoxb-", "xoxp-"]) + chars(digits, 11) + "-" + chars(base, 24),
        "google": lambda: "AIza" + chars(base + "_-", 35), "jwt": lambda: "eyJ" + chars(base + "_-", 30) + "." + chars(base + "_-", 40),
        "base64": lambda: chars(base + "+/", pick([32, 40, 44, 64])),
    }
    hex_key = lambda: chars(pick([hexa, hexa.upper()]), pick([24, 32, 40, 40, 48, 64]))
    password = lambda signs: chars(base + signs, pick([10, 12, 14, 16, 20]))
    names = ["token", "api_key", "apikey", "secret", "password", "passwd", "access_token", "client_secret", "auth_token", "secret_key", "key", "API_KEY", "TOKEN", "PASSWORD"]
    like = ["key", "cache_key", "primary_key", "sort_key", "token", "token_type", "auth", "secret_name", "key_id", "access", "api_key", "password", "KEY"]
    lead = lambda: prose(int(draw.integers(1, 5))) + pick([" ", " ", "\n", ", ", ": "])
    tail = lambda: pick([" " + prose(1), "\n" + prose(1), ". " + prose(1), ", " + prose(1), ") ", ""])

    def assigned(name: str, value: str) -> tuple[str, str, str]:
        quote, mark = pick(['"', "'", "", '"']), pick([" = ", "=", ": ", ":", " : "])
        before = lead() + name + mark + quote if draw.random() < 0.9 else lead() + pick(["Authorization: Bearer ", "-H 'X-Auth: ", "export AWS_SECRET_ACCESS_KEY="])
        return before, value, quote + pick([" ", "\n", "!!", "###", ", ", ""]) + prose(1)

    def placeholder() -> str:
        return pick([lambda: "your_" + word() + "_here", lambda: word() + word() + "_1", lambda: "x" * 20 + "1", lambda: "EXAMPLE" + word() + "1",
                     lambda: "os.environ." + word().upper(), lambda: "REPLACE_" + word().upper() + "_ME", lambda: word().ljust(8, "s")])()

    def identifier() -> str:
        mark = pick(["_", "_", "-", ".", "/"])
        name = mark.join(pick(made)[:int(draw.integers(2, 5))] for _ in range(3)) if draw.random() < 0.3 else snake(mark)  # abbreviations too
        return name + pick(["", mark + chars(digits, int(draw.integers(1, 7)))])

    def camel() -> str:
        return "".join(word().capitalize() for _ in range(3)) + chars(digits, int(draw.integers(1, 5)))

    plain = ["build ", "id=", "see ", "", "path = \"", "url: ", "name: ", "version = \"", "https://www." + pick(known) + ".com/", "/", "key ", "the token ", "href=\""]
    sums = ["commit ", "sha256:", "sha1 ", "md5 = ", "hash: ", "checksum = \"", "etag: \"", "digest ", "revision ", "merge "]
    uuid = lambda: "-".join(chars(hexa, k) for k in (8, 4, 4, 4, 12))
    moment = lambda: "20" + chars(digits, 2) + "-01-" + chars(digits, 2) + "T" + chars(digits, 6) + "Z"
    kinds: dict[str, tuple[int, object]] = {}
    for kind, key in keys.items():
        kinds[f"bare {kind}"] = (1, lambda key=key: (lead(), key(), tail()))
        kinds[f"named {kind}"] = (1, lambda key=key: assigned(pick(names), key()))
    url = lambda: lead() + pick(["postgres", "mysql", "https", "redis", "amqp", "mongodb"]) + "://" + pick(["admin", "root", "app", word()]) + ":"
    kinds |= {
        "named hex": (1, lambda: assigned(pick(names), hex_key())),
        "named password": (1, lambda: assigned(pick(names), password("!@#$%^*"))),
        "named letters and digits": (1, lambda: assigned(pick(names), password(""))),
        "url password": (1, lambda: (url(), chars(base, pick([8, 10, 12, 14, 16, 20])), "@" + word() + pick([".com/", "/", ":5432/"]) + word())),
        "key block": (1, lambda: (lead(), "-----BEGIN " + pick(["", "RSA ", "EC ", "OPENSSH "]) + "PRIVATE KEY-----", "\n" + chars(base, 10))),
        "named identifier": (0, lambda: (lead() + pick(like) + pick([" = \"", ": ", "=", " = "]), identifier().ljust(8, "1"), pick(["\" ", " ", "\n"]))),
        "named placeholder": (0, lambda: (lead() + pick(names) + pick([" = \"", ": ", "="]), placeholder(), "\" ")),
        "named words": (0, lambda: (lead() + pick(like) + pick([": ", " = ", "="]), word().ljust(8, "e"), " " + prose(1))),
        "url placeholder": (0, lambda: (url(), pick(["password", word(), "pass", "changeme", "port"]), "@" + word() + "/")),
        "identifier": (0, lambda: (lead() + pick(plain), identifier().ljust(16, "1"), pick([" ", "\" ", ". ", "/", "\n"]) + prose(1))),
        "path": (0, lambda: (lead() + pick(plain), snake("/", 3, 6) + "/v" + chars(digits, 1), pick([" ", "/", "?"]) + prose(1))),
        "camel": (0, lambda: (lead() + pick(plain), camel(), tail())),
        "number": (0, lambda: (lead() + pick(plain), word() + pick(["", "-", "_", "="]) + chars(digits, 12), tail())),
        "uuid": (0, lambda: (lead() + pick([*plain, "uuid: ", "guid="]), uuid(), tail())),
        "checksum": (0, lambda: (lead() + pick(sums), chars(hexa, pick([32, 40, 64])), tail())),
        "bare hex": (0, lambda: (lead() + pick(["", "", "see "]), chars(hexa, pick([32, 40, 64])), tail())),
        "repeat": (0, lambda: (lead() + pick(plain), pick(["x", "0", "a", "1"]) * int(draw.integers(16, 40)) + "a1", tail())),
        "moment": (0, lambda: (lead() + pick([*plain, "at ", "time: "]), moment(), tail())),
        "page": (0, lambda: (lead() + pick(plain), word() + "." + word() + "/" + word() + "?p=" + chars(digits, 3), tail())),
    }
    return kinds


def labelled_findings(words: list[str], n: int = FINDINGS, seed: int = SEED, without: tuple[str, ...] = (), language: Language | None = None) -> list[tuple[str, str, str, int]]:
    """(before, value, after, secret): half secrets and half what is mistaken for them, kinds in turn, but for the kinds ``without``."""
    draw = np.random.default_rng(seed)
    kinds = [k for name, k in findings_by_kind(words, language or Language(words), draw).items() if name not in without]
    sides = [[make for secret, make in kinds if secret == side] for side in (0, 1)]
    return [(*sides[i % 2][i // 2 % len(sides[i % 2])](), i % 2) for i in range(n)]


class Scanner:
    """The trained scanner; a few megabytes, sent to the tasks as it is."""

    def __init__(self, words: list[str], labelled: list[tuple[str, str, str, int]], pairs: dict | None = None, firsts: dict | None = None):
        self.language = Language(words, pairs, firsts)
        x = np.array([features(self.language, b[-BEFORE:], v, a[:AFTER]) for b, v, a, _ in labelled])
        self.forest = Forest(x, np.array([s for *_, s in labelled], float))

    def find(self, text: str | None) -> list[tuple[int, int, float]]:
        """Start, end and score of each candidate."""
        text = text or ""
        return [found for a, b in candidates(text) for found in self._refined(text, a, b)]

    def _refined(self, text: str, a: int, b: int) -> list[tuple[int, int, float]]:
        """The candidate, or the smaller ones inside it if one of them is a secret."""
        score = self.forest.score(features(self.language, text[max(0, a - BEFORE):a], text[a:b], text[b:b + AFTER]))
        if score < LEAST or "://" in text[a:b]:
            inner = [found for c, d in candidates_inside(text, a, b) for found in self._refined(text, c, d)]
            if any(s >= LEAST for *_, s in inner):
                return inner
        return [(a, b, score)]

    def masked(self, text: str | None) -> str | None:
        if text is None:
            return None
        parts, at = [], 0
        for a, b, score in self.find(text):
            if score >= LEAST:
                parts += [text[at:a], MASK]
                at = b
        return "".join(parts) + text[at:] if parts else text


def fit(docs: DataFrame, findings: DataFrame | None = None) -> Scanner:
    """A scanner trained on ``findings`` (before, value, after, secret; at most `FINDINGS` of them), or on generated ones."""
    words, pairs, firsts = corpus_statistics(docs, whole_below=LATIN)
    if findings is None:
        return Scanner(words, labelled_findings(words, language=Language(words, pairs, firsts)), pairs, firsts)
    given = findings.select("before", "value", "after", F.col("secret").cast("int").alias("secret")).na.drop()
    return Scanner(words, [tuple(r) for r in given.orderBy(F.xxhash64("before", "value", "after")).limit(FINDINGS).collect()], pairs, firsts)


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, start, length, value_sha256, score and secret of each candidate."""
    scanner = fit(docs, findings)
    names = ["doc_id", "start", "length", "value_sha256", "score"]

    def of(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                rows += [(doc_id, a, b - a, hashlib.sha256(text[a:b].encode("utf-8", "surrogatepass")).hexdigest(), s) for a, b, s in scanner.find(text)]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(of, "doc_id long, start long, length long, value_sha256 string, score double")
    return found.withColumn("secret", F.col("score") >= LEAST)


def masked_documents(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` with all their columns; secrets in ``text`` are replaced by `MASK`, other texts stay as they are."""
    scanner = fit(docs, findings)

    def of(batches):
        for batch in batches:
            texts = [scanner.masked(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(of, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
    return out.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")


def op10_secret_scan(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))
