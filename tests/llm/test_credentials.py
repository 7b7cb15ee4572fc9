"""Secrets: the fixed patterns against a plain scan, the lexer against planted assignments, odd texts and time."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from shelfpair.llm import queries
from shelfpair.llm.credentials import find_secrets, lex, literal_spans, pairs_of, sensitivity, spans_of

MIDDLE = "/root/testdata/sf0.01"


def brute_base(text):
    """kind, start, end by trying every place from the left."""
    text, found = text or "", []
    for kind, pattern, least, group in (
        ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
        ("access", r"AKIA[A-Z0-9]+", 20, 0),
        ("hex", r"[0-9a-f]+", 24, 0),
    ):
        for m in re.finditer(pattern, text):
            if len(m[group]) >= least:
                found.append((kind, *m.span()))
    order = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def test_whole_table_against_a_plain_scan(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()))
    rows = queries.op11_secrets(spark, MIDDLE).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and sum(r.n_assign + r.n_hex for r in rows) > 0
    for r in rows:
        want = brute_base(texts[r.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in want) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("literal")] == [s for s in written.split(",") if s]


def test_random_texts_against_a_plain_scan():
    draw = random.Random(5)
    parts = ["password", "PassWD", "api_key", "APIKEY", "toKen", "ſecret", "toKen", " ", "  ", ":", "=", '"', "'", "abc", "0123456789abcdef", "AKIA", "ABCD1234", "é", "🎉", "\n", "secret", "x_y.z", "-"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randrange(30)))
        assert [(s.kind, s.start, s.end) for s in spans_of(text) if s.kind != "literal"] == brute_base(text)


SECRET = "q7Tz9LmK2xVb"
FOUND = [
    f'db_pwd = "{SECRET}"', f"self.client.authToken = '{SECRET}'", f'{{"user": "bob", "clientSecret": "{SECRET}"}}', f'private String privateKey = "{SECRET}";',
    f"const passphrase: string = `{SECRET}`;", f'os.environ["SERVICE_PASS"] = "{SECRET}"', f'login(user="bob", credential="{SECRET}")', f'conf.set("db.passphrase", "{SECRET}")',
    f"export DB_PWD={SECRET}", f"server:\n  port: 80\n  pwd: {SECRET}  # old\n", f"[main]\nsigning-key={SECRET}\n", f"<passphrase>{SECRET}</passphrase>",
    f"tool --host x --passphrase {SECRET} --go", f"tool --access-key={SECRET}", f'pwd := "{SECRET}"', f"$config['pwd'] => '{SECRET}'", f'pwd: str = b"{SECRET}"',
    f'A = "{SECRET}"\nB = A\nlogin(passphrase=B)', f'login(passphrase=LATER)\nLATER = "{SECRET}"', f'pwd = os.getenv("PWD_NAME", "{SECRET}")', f'x = "{SECRET}"\nurl = f"..."\npwd = "${{x}}"',
    f"it's don't 'tis\npwd = '{SECRET}'", f'pwd = decode("{SECRET}")', f"DEFAULT={SECRET}\nexport PWD_X=$DEFAULT\n", f'pwd = (\n    "{SECRET}"\n)',
]
LEFT = [
    'max_tokens = "4096abcXYZ9"', 'password_field = "q7Tz9LmK2xVb"', 'pwd = "changeme"', 'pwd = "your-password-1"', 'pwd = "${VAULT_X}"', "pwd = os.getenv('DB_PWD_1a')", 'pwd = get("service9Xq")',
    'color = "q7Tz9LmK2xVb"', "The passphrase: a story of many words", "auth = required", "pwd = read_it()", "passphrase: nothing\n", 'public_key = "q7Tz9LmK2xVb"', 'pwd = ""', 'token_url = "https://x.y/z9A"',
    "the pass was closed, the key: a lake", 'pwd = "two words here"', 'passphrase = "xxxxxxxx"', "keynote = 'q7Tz9LmK2xVb'",
]


@pytest.mark.parametrize("text", FOUND)
def test_given_to_a_telling_name(text):
    for text in (text, f"Ünï 🎉\n{text}\n"):
        assert [text[s.start : s.end] for s in literal_spans(text)] == [SECRET]


@pytest.mark.parametrize("text", LEFT)
def test_left_alone(text):
    assert literal_spans(text) == []


def test_joined_literals_and_last_assignment():
    text = f'a = "{SECRET}"\na = "Zx81mNp44kQw"\npwd = a + "9Lk2jHg7fDs1"\n'
    assert [text[s.start : s.end] for s in literal_spans(text)] == ["Zx81mNp44kQw", "9Lk2jHg7fDs1"]
    loop = f'a = b\nb = a\npwd = a\nb = "{SECRET}"\n'  # ends
    assert len(literal_spans(loop)) <= 1
    assert sensitivity("AWSSecretAccessKey") == 1 and sensitivity("secretName") == 0 and sensitivity("monkey") == 0


def test_names_and_literals():
    assert [(p.name, [x.text for x in p.literals]) for p in pairs_of('a.b = "x" + "y"; c: "z"')] == [("a.b", ["x", "y"]), ("c", ["z"])]
    assert [t.text for t in lex("don't say 'hi there'") if t.kind == "string"] == ["hi there"]


@pytest.mark.parametrize("piece", ['pwd = "', "\\\"", '"""\\', "pwd = a\na = pwd\n", "'", "<pwd>", "pwd = f(", "--pwd --pwd ", "pwd: ", 'pwd = "a" + '])
def test_time_grows_with_the_text(piece):
    took = []
    for n in (20_000, 80_000):
        text = "pwd " + piece * (n // len(piece))
        began = time.perf_counter()
        spans_of(text)
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 0.3, took


def test_odd_rows(spark):
    rows = [(None, None, "a"), (1, "", "b"), (1, f'pwd = "{SECRET}"', "c"), (1, f'pwd = "{SECRET}"', "c"), (2, "word " * 300_000 + f"\npwd={SECRET}", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string").withColumn("kind", F.lit(1))
    got = find_secrets(docs).collect()
    assert [len(r.secrets) for r in sorted(got, key=lambda r: (r.doc_id or 0, len(r.text or "")))] == [0, 0, 1, 1, 1]
    assert find_secrets(docs.limit(0)).count() == 0 and got[0].kind == 1
    assert all(s.name == "pwd" and s.kind == "literal" for r in got for s in r.secrets)

