"""Base spans against a scan by hand, and the assignment reader on small sources."""

import hashlib
import re

import pytest

from kontor.llm import secretscan

SF = "/root/testdata/sf0.001"


def by_hand(text):
    """The base rule, one kind after the other, each from left to right."""
    text = text or ""
    found = []
    rules = [
        (r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?(?P<v>[A-Za-z0-9+/_.=-]+)", "assign", 8),
        (r"(?P<v>AKIA[A-Z0-9]+)", "access", 16), (r"(?P<v>[0-9a-f]+)", "hex", 32),
    ]
    for place, (rule, kind, least) in enumerate(rules):
        at = 0
        while (match := re.compile(rule).search(text, at)) is not None:
            at = match.end()
            if len(match["v"]) >= least:
                found.append((match.start(), place, f"{kind}:{match.start()}:{match.end()}"))
    return [one for _, _, one in sorted(found)]


ODD = [
    None, "", "no secrets here: none", "PassWord='abcdefgh' token=short api_key : ABCDEFGHIJ", "AKIAABCDEFGHIJKL AKIASHORT",
    "é日本 token = \"0123456789abcdef0123456789abcdef\" x", "deadbeef" * 4 + "x" + "a" * 31, "ſecret=abcdefghij toKen=abcdefghij",
    "token=token=abcdefgh", "secret: " * 3, "x" * 200_000 + " token=abcdefgh1", "f" * 50_000,
]


def test_base_spans_match(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(row.doc_id, row.text) for row in docs] + [(10_000 + i, text) for i, text in enumerate(ODD)] + [(None, ODD[3])]
    frame = spark.createDataFrame([(*row, "extra") for row in rows], "doc_id long, text string, spans string")
    found = secretscan.scan(frame).collect()
    assert len(found) == len(rows)
    want = sorted((key, hashlib.sha256(",".join(by_hand(text)).encode()).hexdigest()) for key, text in rows if key is not None)
    assert sorted((row.key, row.base_sha256) for row in found if row.key is not None) == want
    for row in found:
        assert row.n_assign + row.n_access + row.n_hex + row.n_named == len(row.spans)


def test_empty(spark):
    assert secretscan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text, values", [
    ('const dbPwd = "hG7!kq29ZpXw";', ["hG7!kq29ZpXw"]),
    ('key1 = "zX81-kPq7-Lm2v"\nclient_secret_value = "aaaa"\nauth_credentials = key1', ["zX81-kPq7-Lm2v"]),
    ('a = "Qw3rtyU10pAs"\nb = a\nsigning_key = b\n', ["Qw3rtyU10pAs"]),
    ('private_key = "abCD12" + "efGH34"', ["abCD12", "efGH34"]),
    ("export DB_PASSPHRASE=s3cr3tV4lu3x9", ["s3cr3tV4lu3x9"]),
    ('{"auth_credentials": "Zm9vYmFyMTIz", "name": "Zm9vYmFyMTIz"}', ["Zm9vYmFyMTIz"]),
    ('pwd: "your_password_here"', []), ('passphrase = "${PASSPHRASE}"', []), ("public_key = 'MIIBIjANBgkqh9'", []),
    ('PREFIX="sk_live_"\ntoken = PREFIX + "4eC39HqLyjWDarjtT1zdp7dc"', ["sk_live_", "4eC39HqLyjWDarjtT1zdp7dc"]),
    ('a = "x9"\nb = a + "Kq7-"\nsigning_key = b + "Lm2v" + \'Zt5\'', ["x9", "Kq7-", "Lm2v", "Zt5"]),
    ('greeting = "Hello you there, friend"\nname = greeting + "Zt5Kq7Lm2v"', []),
    ('client_secret = host + "Zt5-Kq7-Lm2v"\nclient_secret = client_secret + "Wx3"', ["Zt5-Kq7-Lm2v", "Wx3"]),
    ('<add key="ApiSecret" value="Zt5!Kq7!Lm2v" />', ["Zt5!Kq7!Lm2v"]), ('<add key="Title" value="Zt5!Kq7!Lm2v" />', []),
    ('tls:\n  private_key: |\n    -----BEGIN KEY-----\n    MIIEpAIBAAKCAQEA1\n\n    x9Zt5Kq7Lm2v\n    -----END KEY-----\n  port: 80\n',
     ["MIIEpAIBAAKCAQEA1", "x9Zt5Kq7Lm2v"]),
    ('title = "zX81-kPq7-Lm2v"', []), ("pwd_path = '/etc/keys/one9'", []), ("The key: a word about passwords and more.", []),
])
def test_named(text, values):
    base, spans = secretscan.secret_spans(text)
    assert [text[a:b] for a, b, kind in spans if kind == "named"] == values
    assert set(base) <= set(spans)


@pytest.mark.parametrize("text, values", [
    ('db_password = "Summer2024!Rain#77xQ"', ["Summer2024!Rain#77xQ"]),
    (f'signing_key = "Zq-{"0123456789abcdef" * 2}-Kx7"', [f'Zq-{"0123456789abcdef" * 2}-Kx7']),
    ('secret = "abcdEFGH1234"', []),  # the base span holds it whole
])
def test_named_beside_base(text, values):
    base, spans = secretscan.secret_spans(text)
    assert len(base) == 1 and set(base) <= set(spans)
    assert [text[a:b] for a, b, kind in spans if kind == "named"] == values


@pytest.mark.parametrize("name", ["spring." + "cloud.config." * 8 + "credentials", "a-" * 500 + "signing-key", "x" * 200 + "_pwd"])
def test_long_names(name):
    for text in (f'{name} = "hG7!kq29ZpXw"', f'"{name}": "hG7!kq29ZpXw"', f'env["{name}"] = "hG7!kq29ZpXw"'):
        assert [text[a:b] for a, b, kind in secretscan.secret_spans(text)[1] if kind == "named"] == ["hG7!kq29ZpXw"]


def test_long_names_stay_linear():
    import time

    start = time.perf_counter()
    for text in ("a" * 400_000 + " x=y", "k=" + "a" * 400_000 + "(", "k=" + "a.b(" * 100_000, "'a" * 100_000 + "=", "a[" * 100_000 + "="):
        secretscan.secret_spans(text)
    assert time.perf_counter() - start < 20


def test_long_lines_stay_linear():
    import time

    start = time.perf_counter()
    for text in ('a="' * 60_000, "a." * 100_000 + "=", "key=" * 50_000, "'" * 200_000 + "=", "key: |\n" * 50_000, "\n" * 200_000,
                 "key: |\n  a\n" * 30_000, "key='a' value=" * 30_000, "".join(f"k{i} = k{i + 1} + 'a'\n" for i in range(20_000)), "a = 'b' + " * 30_000):
        secretscan.secret_spans(text)
    assert time.perf_counter() - start < 20
