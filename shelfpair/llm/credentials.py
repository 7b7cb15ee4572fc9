"""Secrets in texts: fixed patterns, and an assignment-aware lexer that scores literals by the names they are given to."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict, namedtuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpair.llm.common import without

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs shorter than 24 fail anyway, and a longer run is found whole.
HEX = re.compile(r"[0-9a-f]{24,}")

Span = namedtuple("Span", "kind start end name score")
Token = namedtuple("Token", "kind text start end")
Literal = namedtuple("Literal", "start end text quoted")
Pair = namedtuple("Pair", "name start literals references")


def base_spans(text: str) -> list[Span]:
    """What the three patterns find, in code points, leftmost and without overlap for each kind."""
    low, found = text.lower(), []
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [Span("assign", *m.span(), m[1], 1.0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [Span("access", *m.span(), None, 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [Span("hex", *m.span(), None, 1.0) for m in HEX.finditer(text)]


# lexing

NEXT = re.compile(
    r"""(?P<name>[A-Za-z_$][\w$]*+(?:[.-][A-Za-z_][\w$]*+)*+)"""
    r"""|(?P<quote>\"{3}|'{3}|["'`])"""
    r"""|(?P<mark>:=|=>|={2,}|[!<>]=|[=:,;()\[\]{}<>+\n])"""
    r"""|(?P<bare>[^\s"'`=:,;()\[\]{}<>+]+)"""
)
BODY = {'"': r'(?:\\.|[^"\\\n])*+', "'": r"(?:\\.|[^'\\\n])*+", "`": r"(?:\\.|[^`\\])*+", '"""': r'(?:\\.|[^"\\]|"(?!""))*+', "'''": r"(?:\\.|[^'\\]|'(?!''))*+"}
BODY = {quote: re.compile(body, re.S) for quote, body in BODY.items()}
NAME = re.compile(r"[\w$][\w$ .-]{0,63}").fullmatch
FLAG = re.compile(r"--?([A-Za-z][\w-]*)").fullmatch
REFERENCE = re.compile(r"\$?\{+\s*([A-Za-z_]\w*)\s*\}+|\$([A-Za-z_]\w*)|%([A-Za-z_]\w*)%").fullmatch
#: A value without quotes that ends its line, or is followed by a comment only.
VALUE = re.compile(r"""[ \t]*([^\s"'`#;,(){}<>\[\]][^\s"'`,;]*)[ \t]*[,;]?[ \t]*(?:(?:#|//|;).*)?(?=\r?$)""", re.M)
WORD = re.compile(r"""([^\s"'`#;,(){}<>\[\]][^\s"'`,;]*)""")
START = re.compile(r"(?:^|(?<=\n))[ \t]*(?:export[ \t]+|set[ \t]+|-[ \t]+|#+[ \t]*|//+[ \t]*|%+[ \t]*)?\Z")
ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)>[ \t]*([^<>\s]+)[ \t]*</\1>")
#: Calls whose first argument names what the second is, and calls whose first argument is the name of what they look up.
SETTERS = {"set", "put", "add", "append", "header", "option", "property", "setenv", "setdefault", "config", "param", "env", "define"}
GETTERS = {"get", "getenv", "environ", "env", "getproperty", "lookup", "getattr"}


def lex(text: str) -> list[Token]:
    """Names, string literals (without their quotes), marks and other runs, in order.

    A quote that nothing closes (on its line, for plain quotes) is skipped, as is an apostrophe inside a word; every
    character is looked at a bounded number of times, whatever the quotes.
    """
    tokens, at, dead = [], 0, dict.fromkeys(BODY, -1)
    while m := NEXT.search(text, at):
        at = m.end()
        if m.lastgroup != "quote":
            tokens.append(Token(m.lastgroup, m[0], m.start(), at))
            continue
        quote = m[0]
        if m.start() < dead[quote] or quote == "'" and m.start() and text[m.start() - 1].isalnum() and text[m.start() - 2 : m.start()].strip(" =:(,[+").lower() not in ("b", "f", "r", "u", "n"):
            continue
        end = BODY[quote].match(text, at).end()
        if text.startswith(quote, end):
            tokens.append(Token("string", text[at:end], at, end))
            at = end + len(quote)
        else:
            dead[quote] = end
    return tokens


def words_of(name: str) -> list[str]:
    """The words of a name in any of the usual styles, in lower case."""
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", name)]


def pairs_of(text: str) -> list[Pair]:
    """Name-literal pairs of source and configuration syntax in the order of the text.

    name = "x", name: type = "x", "name": "x", table["name"] = "x", call(name="x"), set("name", "x"), --name x,
    <name>x</name>, and lines name=x, name: x, export name=x without quotes. Values may be joined from several literals,
    wrapped in calls, or refer to other names.
    """
    tokens, pairs = lex(text), []
    n = len(tokens)
    kind = lambda k: tokens[k].kind if 0 <= k < n else "end"
    mark = lambda k: tokens[k].text if 0 <= k < n and tokens[k].kind == "mark" else ""

    def operand(k: int, literals: list, references: list) -> int:
        """Reads a value at token k; the number of the token after it, or k if there is none."""
        if kind(k) == "string":
            t = tokens[k]
            inner = REFERENCE(t.text)
            references.append((next(filter(None, inner.groups())), t.start)) if inner else literals.append(Literal(t.start, t.end, t.text, True))
            return k + 1
        if kind(k) != "name":
            return k
        if kind(k + 1) == "string" and tokens[k + 1].start <= tokens[k].end + 3 and len(tokens[k].text) <= 2:  # b"x", f"x"
            return operand(k + 1, literals, references)
        if mark(k + 1) not in ("(", "["):
            references.append((tokens[k].text, tokens[k].start))
            return k + 1
        depth, first, getter = 0, True, re.split(r"[.-]", tokens[k].text)[-1].lower() in GETTERS
        for j in range(k + 1, min(n, k + 40)):
            depth += (mark(j) in ("(", "[")) - (mark(j) in (")", "]"))
            if kind(j) == "string" and depth == 1:
                if not (getter and first):
                    operand(j, literals, references)
                first = False
            if depth == 0:
                return j + 1
        return k + 1

    def value(k: int) -> tuple[list, list]:
        literals, references, depth = [], [], 0
        while mark(k) == "(" or depth and mark(k) == "\n":
            depth += mark(k) == "("
            k += 1
        while (after := operand(k, literals, references)) != k:
            k = after
            while depth and mark(k) == "\n":
                k += 1
            if mark(k) == "+":
                k += 1
                while mark(k) == "\n":
                    k += 1
            elif kind(k) != "string" or not literals:
                break
        return literals, references

    for k in range(n):
        if kind(k) == "bare" and (flag := FLAG(tokens[k].text)) and kind(k + 1) in ("string", "bare", "name"):
            t = tokens[k + 1]
            plain = t.kind != "string"
            if plain:  # up to the next white space
                m = WORD.match(text, t.start)
                t = Token("bare", m[0], *m.span()) if m else t
            pairs.append(Pair(flag[1], tokens[k].start, [Literal(t.start, t.end, t.text, not plain)], []))
        if mark(k) == "(" and kind(k + 1) == kind(k + 3) == "string" and mark(k + 2) == "," and kind(k - 1) == "name":
            if SETTERS.intersection(words_of(tokens[k - 1].text)):
                t = tokens[k + 3]
                pairs.append(Pair(tokens[k + 1].text, tokens[k + 1].start, [Literal(t.start, t.end, t.text, True)], []))
        if mark(k) not in ("=", ":", ":=", "=>"):
            continue
        left = k - 1
        if mark(left) == "]" and kind(left - 1) in ("string", "name") and mark(left - 2) == "[":
            left -= 1
        elif mark(k) == "=" and kind(left) == "name" and mark(left - 1) == ":" and kind(left - 2) == "name":  # name: type = value
            left -= 2
        if kind(left) not in ("name", "string") or not NAME(tokens[left].text):
            flag = FLAG(tokens[left].text) if kind(left) == "bare" else None
            if not flag:
                continue
            name = flag[1]
        else:
            name = tokens[left].text
        literals, references = value(k + 1)
        line = START.search(text, max(0, tokens[left].start - 200), tokens[left].start - (kind(left) == "string"))
        if not literals and (line or kind(left) == "bare") and (m := (VALUE if line else WORD).match(text, tokens[k].end)) and not (mark(k) == ":" and m[1].startswith("//")):
            inner = REFERENCE(m[1])
            if inner:
                references = [(next(filter(None, inner.groups())), m.start(1))]
            else:  # perhaps a literal, perhaps a name: the names known tell
                literals = [Literal(*m.span(1), m[1], False)]
        if literals or references:
            pairs.append(Pair(name, tokens[left].start, literals, references))
    if "</" in text:
        pairs += [Pair(m[1], m.start(), [Literal(*m.span(2), m[2], False)], []) for m in ELEMENT.finditer(text)]
        pairs.sort(key=lambda p: p.start)
    return pairs


# scoring

#: What the words of a name add: alone, and together.
STRONG = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.8, "credentials": 0.8, "bearer": 0.8, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "authtoken": 1.0, "pass": 0.7, "auth": 0.6, "authorization": 0.7}
BEFORE_KEY = {"api", "access", "private", "secret", "encryption", "signing", "master", "account", "shared", "session", "service", "storage", "auth", "license", "cipher", "hmac", "aes"}
#: A name that ends in one of these is about a secret, but not the secret.
ABOUT = {"name", "id", "count", "length", "len", "type", "url", "uri", "path", "file", "filename", "field", "label", "hint", "policy", "regex", "pattern", "format", "expiry", "expires", "expiration", "ttl", "timeout", "size", "limit", "prompt", "message", "error", "env", "var", "variable", "column", "header", "prefix", "endpoint", "version", "algorithm", "provider", "manager", "class", "title", "text", "placeholder"}
PLACEHOLDER = re.compile(r"(?i)(?:none|null|nil|true|false|undefined|empty|required|optional|string|str|int|bool|secret|password|passwd|token|redacted|hidden|todo|tbd|n/?a|change.?(?:me|it|this)|replace.?(?:me|this)|your.*|my.?(?:password|secret|token|key)|.*example.*|.*placeholder.*|dummy|sample|(.)\1*|[*x.#_-]+|<.*>|\$.*|\{.*|%.*|@.*)\Z").match
THRESHOLD = 0.5


def sensitivity(name: str) -> float:
    """0 to 1: how much the words of a name say that its value is secret."""
    words = words_of(name)
    if not words or words[-1] in ABOUT or "public" in words:
        return 0.0
    score = max((STRONG.get(w, 0.0) for w in words), default=0.0)
    joined = max((STRONG.get(a + b, 0.0) for a, b in zip(words, words[1:])), default=0.0)
    keyed = 0.9 if any(a in BEFORE_KEY and b in ("key", "keys") for a, b in zip(words, words[1:])) else 0.0
    return max(score, joined, keyed)


def randomness(literal: Literal) -> float:
    """0 to 1: how much a literal looks like a secret; 0 for placeholders, sentences, addresses and short values."""
    text = literal.text
    if len(text) < 6 or any(c.isspace() for c in text) or PLACEHOLDER(text) or "://" in text or text.startswith(("/", "./", "~/")):
        return 0.0
    n = len(text)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(text).values())
    classes = sum(any(map(test, text)) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    if not literal.quoted and (classes < 2 or not any(c.isdigit() for c in text)):  # a word, a number or a name
        return 0.0
    return min(1.0, entropy / 4.0) * (0.55 + 0.15 * classes)


def literal_spans(text: str) -> list[Span]:
    """Literals that are given, directly or through other names, to a name that tells of a secret.

    A reference stands for what its name was last given before it, or else is first given after it. Literals are scored
    by the most telling name they reach; a chain of references is followed once, so the work grows with the text.
    """
    if not any(stem in text.lower() for stem in ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer")):
        return []
    pairs = pairs_of(text)
    given, places = defaultdict(list), defaultdict(list)
    for k, pair in enumerate(pairs):
        for name in {pair.name, re.split(r"[.]", pair.name)[-1]}:
            given[name].append(k)
            places[name].append(pair.start)
    best: dict[tuple[int, int], Span] = {}
    seen: set[int] = set()
    told = sorted(((sensitivity(p.name), -k) for k, p in enumerate(pairs)), reverse=True)
    for name_score, k in told:
        if name_score == 0:
            break
        todo = [-k]
        while todo:
            pair = pairs[k := todo.pop()]
            if k in seen:
                continue
            seen.add(k)
            references = list(pair.references)
            for literal in pair.literals:
                if not literal.quoted and literal.text in given:
                    references.append((literal.text, literal.start))
                    continue
                score = name_score * min(1.0, randomness(literal) + (0.15 if literal.quoted else 0.0)) if randomness(literal) else 0.0
                if score >= THRESHOLD:
                    best.setdefault((literal.start, literal.end), Span("literal", literal.start, literal.end, pair.name, round(score, 6)))
            for name, at in references:
                name = name if name in given else re.split(r"[.]", name)[-1]
                if known := given.get(name):
                    place = bisect_left(places[name], at) - 1
                    other = known[max(place, 0)]
                    if other == k and place > 0:
                        other = known[place - 1]
                    todo.append(other)
    return sorted(best.values(), key=lambda s: s.start)


def spans_of(text: str | None) -> list[Span]:
    """All spans of a text, by start, then kind as listed in KINDS, then end."""
    text = text or ""
    return sorted(base_spans(text) + literal_spans(text), key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def find_secrets(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` (text, and any others) and ``secrets``: array of (kind, start, end, name, score).

    Whole texts are searched; null and empty ones hold none. Offsets are code points, the end exclusive. Kinds: the three
    fixed patterns (score 1), and ``literal``, found by lexing, with the name it was given to. Spans are ordered by start,
    kind and end; spans of different kinds may overlap. Every row comes back, repeated rows too; a column ``secrets`` of the
    input is replaced.
    """
    rows = without(docs, "secrets")
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = [[span._asdict() for span in spans_of(text)] for text in texts.to_pylist()]
            columns = [*batch.columns[:-1], pa.array(found, pa.list_(kind))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "secrets"])

    text = next(name for name in docs.columns if name.lower() == "text")
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    again = rows.select(*[F.col(f"`{name}`") for name in rows.columns], F.col(f"`{text}`").alias("text to search"))
    return again.mapInArrow(run, f"{schema}, secrets array<struct<kind string, start bigint, end bigint, name string, score double>>")


def listed(spans) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal) of every row of ``docs`` (doc_id, text).

    base_sha256 is the digest of the spans of the fixed patterns, written kind:start:end and joined by commas; spans lists
    all. Null, empty and repeated rows each come back; further columns are ignored.
    """

    def run(batches):
        for batch in batches:
            found = [spans_of(text) for text in batch.column(1).to_pylist()]
            counts = [Counter(s.kind for s in spans) for spans in found]
            base = [listed(s for s in spans if s.kind != "literal") for spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array([c[k] for c in counts], pa.int64()) for k in KINDS[:3]],
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    pa.array([listed(spans) for spans in found], pa.string()),
                    pa.array([c["literal"] for c in counts], pa.int64()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"],
            )

    out = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, out)
