"""Secret scan: the base patterns against a character-by-character version, the lexer against written cases."""

import hashlib
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandloom.llm import registry, secrets
from tests.llm.helpers import SF_DIR, as_set, no_documents, odd_documents

VALUE = set(string.ascii_letters + string.digits + "+/_.=-")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def brute_base(text):
    """(kind, start, end) of the base patterns, read one character at a time."""
    low = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    found, i = [], 0
    while i < len(text):
        end = next((e for k in KEYWORDS if low.startswith(k, i) for e in [assign_end(text, i + len(k))] if e), None)
        if end:
            if end[1] - end[0] >= 6:
                found.append(("assign", i, end[1]))
            i = end[1]
        else:
            i += 1
    for kind, start, allowed, least in (
        ("access", "AKIA", string.ascii_uppercase + string.digits, 20), ("hex", "", "0123456789abcdef", 24),
    ):
        i = 0
        while i < len(text):
            end = i + len(start)
            while text.startswith(start, i) and end < len(text) and text[end] in allowed:
                end += 1
            if end > i + len(start):
                if end - i >= least:
                    found.append((kind, i, end))
                i = end
            else:
                i += 1
    return sorted(found, key=lambda f: (f[1], ("assign", "access", "hex").index(f[0])))


def assign_end(text, at):
    """(start, end) of the value after a keyword that ends at ``at``, or None."""
    at += text[at : at + 1] in ("'", '"')
    while text[at : at + 1] == " ":
        at += 1
    if text[at : at + 1] not in (":", "="):
        return None
    at += 1
    while text[at : at + 1] == " ":
        at += 1
    at += text[at : at + 1] in ("'", '"')
    end = at
    while end < len(text) and text[end] in VALUE:
        end += 1
    return (at, end) if end > at else None


def base_row(doc_id, text):
    found = brute_base(text or "")
    counts = [sum(k == kind for k, *_ in found) for kind in ("assign", "access", "hex")]
    return (doc_id, *counts, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest())


PIECES = st.sampled_from([
    "password", "Passwd", "SECRET", "token", "api_key", "apikey", "API", "_", "key", '"', "'", " ", "  ", "=", ":", "\n", "AKIA",
    "ABCDEFGHIJKLMNOP", "0123456789", "abcdef", "deadbeefdeadbeef", "é", "\u017f", "\u212a", "x", "-", "/", "\U0001f600", "+",
])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_base_patterns(text):
    spans = [(s.kind, s.start, s.end) for s in secrets.base_spans(text)]
    assert sorted(spans, key=lambda f: (f[1], secrets.KINDS.index(f[0]))) == brute_base(text)
    everything = secrets.spans_of(text)
    assert [(s.kind, s.start, s.end) for s in everything if s.kind in secrets.BASE] == brute_base(text)
    assert all(0 <= s.start < s.end <= len(text) for s in everything)


@pytest.mark.parametrize("text, expected", [
    # source code
    ('db_pwd = "hunter2!x"', [("literal", "hunter2!x")]),
    ("String dbPwd = 'p@ss w0rd!9';", [("literal", "p@ss w0rd!9")]),
    ('var signingKey string = "a9F3kd02Lx"', [("literal", "a9F3kd02Lx")]),
    ('signing_key: str = "a9F3kd02Lx"', [("literal", "a9F3kd02Lx")]),
    ('signingKey:string="a9F3kd02Lx"', [("literal", "a9F3kd02Lx")]),
    ('clientSecretValue := `zX81-qq02-77`', [("literal", "zX81-qq02-77")]),
    ('config["private_key"] = b"MIIEvQ9aB2"', [("literal", "MIIEvQ9aB2")]),
    ("{'access-key' => 'Zk29dkQ0pL'}", [("literal", "Zk29dkQ0pL")]),
    ('connect(user="bob", passphrase=("blue42Horse"))', [("literal", "blue42Horse")]),
    # configuration
    ('{"user": "x", "credentials": "Zk29dkQ0pL", "n": 5}', [("literal", "Zk29dkQ0pL")]),
    ("export MASTER_KEY=Zk29dkQ0pL==", [("literal", "Zk29dkQ0pL==")]),
    ("  - authCredential: Zk29dkQ0pL  # no", [("literal", "Zk29dkQ0pL")]),
    # constants
    ('K = "Zk29dkQ0pL"\nclient.password = K', [("constant", "Zk29dkQ0pL")]),
    ('a = "Zk29dkQ0pL"\nb = a\nc = b\nlogin(pwd=c)', [("constant", "Zk29dkQ0pL")]),
    ('a = "Zk29" + "dkQ0pL"\nmy_secret_value = a + "qz9Kx8"', [("constant", "Zk29"), ("constant", "dkQ0pL"), ("literal", "qz9Kx8")]),
    ('a = "Zk29dkQ0pL"\na = "another"\nx = a', []),
    ('a = "Zk29dkQ0pL"\na = load()\npwd = a', []),
    ('pwd = a\na = "Zk29dkQ0pL"', []),
    # a literal that a base pattern cuts short, and one that it holds whole
    ('password = "abc!defghij9"', [("literal", "abc!defghij9")]),
    ('password = "abcdefghij9"', []),
    # no secrets
    ("the password: forgotten words are no secret: nothing", []),
    ('pwd = "changeme-please"; pwd2 = "${DB_PWD}"; pwd3 = "xxxxxxxx"; pwd4 = "<your pwd>"', []),
    ('pwd = getpass("Zk29dkQ0pL"); passwd_file = "/etc/app/passwd9"; max_tokens = 4096000', []),
    ('secret_name = "Zk29dkQ0pL"; token_type = "Bearer99x"', []),
    ("author: Zk29dkQ0pL; keyboard = Zk29dkQ0pL; it's a = 'Zk29dkQ0pL'", []),
    ('note = "the password is a secret"', []),
    ("pwd == 'Zk29dkQ0pL' != pwd", []),
])
def test_assignments(text, expected):
    found = [s for s in secrets.spans_of(text) if s.kind not in secrets.BASE]
    assert [(s.kind, text[s.start : s.end]) for s in found] == expected
    assert all(s.score >= secrets.THRESHOLD for s in found)


def test_many_bindings_take_linear_work():
    """A long chain of constants with a sensitive use of each, and a name that is set from itself."""
    text = 'v0 = "Zk29dkQ0pL"\n' + "".join(f"v{i} = v{i - 1}\nuser{i}.pwd = v{i}\n" for i in range(1, 20_000))
    text += 's = "Ab12Cd34Ef"\n' + 's = s + "Xy98Zw76Vu"\n' * 20_000 + "login.pwd = s\n"
    found = [s for s in secrets.spans_of(text) if s.kind == "constant"]
    assert len(found) == 20_002


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = registry.secret_spans(spark, SF_DIR).collect()
    assert registry.secret_spans(spark, SF_DIR).columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert as_set(r[:5] for r in found) == as_set(base_row(*r) for r in rows)
    # each base span is among all spans, which are in order
    texts = dict(rows)
    for r in found:
        spans = [(k, int(s), int(e)) for k, s, e in (p.split(":") for p in r.spans.split(",") if p)]
        assert [s for s in spans if s[0] in secrets.BASE] == brute_base(texts[r.doc_id])
        assert spans == sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_planted_tokens(spark):
    """Documents that name a token, in a larger table; every other one has no assigned secret."""
    larger = SF_DIR.replace("0.001", "0.01")
    named = [(r.doc_id, r.text) for r in spark.read.parquet(f"{larger}/documents.parquet").where("text ilike '%token%'").collect()]
    found = registry.secret_spans(spark, larger).collect()
    assert as_set(r[:5] for r in found if r.doc_id in dict(named)) == as_set(base_row(*r) for r in named)
    assert {r.doc_id for r in found if r.n_assign} == set(dict(named)) and len(named) > 10


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = secrets.digest(docs).collect()
    assert as_set(r[:5] for r in found) == as_set(base_row(r.doc_id, r.text) for r in docs.collect())


def test_empty_table_clashing_names_and_positions(spark):
    assert secrets.digest(no_documents(spark)).count() == 0
    text = "\U0001f600é pwd = 'Zk29dkQ0pL'"
    docs = spark.createDataFrame([(None, text, 1, 2, 3)], "doc_id long, text string, spans long, secrets long, kind long")
    row = secrets.digest(docs).first()
    assert (row.doc_id, row.spans) == (None, f"literal:{text.index('Zk')}:{len(text) - 1}")
    assert secrets.scan(docs).first().secrets[0].name == "pwd"
