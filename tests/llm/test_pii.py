import random
import re

from cases import awkward, empty

from tessera.llm.pii import luhn, personal_data, redacted, spans

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def base(text):
    return [s for s in spans(text) if s[0] in PATTERNS]


def test_base_spans_are_those_of_the_patterns():
    rnd = random.Random(3)
    parts = ["a", "Z9", "@", "@x", ".", ".com", "1.2.3.4", "256", ".7", "+", "+1 (017) 555-7713", "4111 1111-1111 1111", "4929348385146306", " ", "-", "é", "(", "%", "_", "12", "http://", "token = ", "\n"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert base(text) == plain(text), text


def test_known_cases():
    assert base("x@y@z.com, a.b+c@d.e.f.") == [("email", 2, 9), ("email", 11, 22)]
    assert base("1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.0255") == [("ip", 0, 7), ("ip", 8, 15), ("ip", 26, 42)]
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert base("9" * 6000) == []
    assert [s[0] for s in spans("see https://a.example.com/x?y=1. token = \"04dbebab91ab85687d33\" 日本 me@b.co")] == ["email", "url", "account"]


def test_added_spans_leave_base_ones():
    text = "iban: DE89370400440532013000 http://u@h.example.org/1.2.3.4 Account no: 4111111111111111"
    assert base(text) == plain(text)
    assert {"url", "account"} <= {s[0] for s in spans(text)}


def test_accounts_of_any_length_and_spelling():
    found = lambda text: [text[a:b] for k, a, b in spans(text) if k == "account"]
    long = "a1B2" * 500
    assert found(f"token: {long} end") == [long]
    assert found("apiKey=sk_live_51H8xyz99.AbC, next") == ["sk_live_51H8xyz99.AbC"]
    assert found("PassPort No. X1234567.") == ["X1234567"]
    assert found("iban: DE89 3704 0044 0532 0130 00 and more words") == ["DE89 3704 0044 0532 0130 00"]
    assert found("SSN 123-45-6789 of it") == ["123-45-6789"]
    assert found("the token of my account is gone, password: swordfish") == []
    assert [k for k, *_ in spans("HTTPS://" + "u" * 200 + "@host.example.org/x")][-1] == "url"
    assert found("İİ İ token: 12345678") == ["12345678"]


def test_rows(spark):
    df = awkward(spark, [(20, "😀 mail a@b.co and 10.0.0.1"), (21, "x" * 50_000 + " +1 (017) 555-7713")])
    got = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in personal_data(df).collect()}
    assert got == {(r.doc_id, tuple(spans(r.text or ""))) for r in df.collect()}
    assert (20, (("email", 7, 13), ("ip", 18, 26))) in got
    text = {r.doc_id: r.text for r in redacted(df).collect()}
    assert text[20] == "😀 mail <email> and <ip>" and text[3] is None
    assert personal_data(empty(spark)).collect() == []


def test_query_columns(spark, tmp_path):
    import hashlib

    from tessera.llm.queries import op3_personal_data

    df = awkward(spark, [(30, "a@b.co 1.1.1.1 https://x.example.com/ +1 (017) 555-7713")])
    df.write.parquet(f"{tmp_path}/documents.parquet")
    for r in op3_personal_data(spark, str(tmp_path)).collect():
        text = next(x.text or "" for x in df.collect() if x.doc_id == r.doc_id)
        own = spans(text)
        spell = lambda some: ",".join(f"{k}:{a}:{b}" for k, a, b in some)
        assert r.spans == spell(own)
        assert r.base_sha256 == hashlib.sha256(spell(s for s in own if s[0] in PATTERNS).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in own) for k in PATTERNS)
