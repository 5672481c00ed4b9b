import hashlib
import random
import re

from quakeframe.llm import queries, sanitise


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v // 10 + v % 10 for v in doubled) % 10 == 0


def slow(text):
    """Base spans by the patterns as they are stated."""
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [(kind, *m.span()) for kind, (pattern, fits) in checks.items() for m in re.finditer(pattern, text or "") if fits(m)]


def checked(row, text):
    base = slow(text)
    listed = ",".join("%s:%d:%d" % s for s in base)
    assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), text
    assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == [sum(s[0] == k for s in base) for k in sanitise.PATTERNS]
    spans = row["spans"].split(",") if row["spans"] else []
    assert spans[: len(base)] == (listed.split(",") if listed else [])
    return [text[int(a) : int(b)] for kind, a, b in (s.split(":") for s in spans[len(base) :])]


def test_base_spans(docs):
    draw = random.Random(2)
    parts = ["a.b", "@", "c-d", ".e", "_", "%", "1.2.3.4", "255.01.0.256", "4111 1111-1111 1111", "4111111111111112", "+1 (23) 456-7890", "+49..", " ", "\n", "é日", "..", "-", "+", "0", "7"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(25))) for _ in range(400)]
    texts += [None, "", "a@b.c_d@e.f", "a@b.c.@d.e", "1.2.3.4.5.6.7.8", "1" * 5000 + "@x", "a" * 200000, "x@y" + ".z" * 20000, "12 " * 20000, "+1" + " " * 3000]
    rows = {r["doc_id"]: r for r in sanitise.personal_data(docs([*enumerate(texts)]).repartition(3), support=10**6).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert checked(rows[i], text) == []


MAIL = "ann.lee@example.org"


def corpus():
    """A word that stands near one address only, one that stands near others too, and common words."""
    common = "the of and to in that it was for on with as at by from they were".split()
    draw = random.Random(4)

    def some(n):
        return " ".join(draw.choices(common, k=n))

    texts = [f"{some(8)} Zanzibari, {some(2)} {MAIL} {some(20)}" for _ in range(6)]
    texts += [f"{some(5)} plumber {MAIL} {some(9)}" for _ in range(3)] + [f"{some(15)} plumber {some(15)}" for _ in range(300)]
    texts += [f"{some(8)} lonely 10.0.0.{i} {some(20)}" for i in range(9)]
    texts += [f"{some(9)} hapax{'abc'[i]} bob@example.org" for i in range(3)] + ["unicorn bob@example.org"] * 50
    return texts + [some(40) for _ in range(200)]


def test_terms_that_reveal(docs):
    texts = corpus()
    rows = {r["doc_id"]: r for r in sanitise.personal_data(docs([*enumerate(texts)])).collect()}
    added = {i: checked(rows[i], text) for i, text in enumerate(texts)}
    assert all(added[i] == ["Zanzibari"] for i in range(6))  # always near this address
    assert not any(added[i] for i in range(6, len(texts)))  # 3 of 303; near nine addresses; one text each; copies of one text
    assert all(rows[i]["spans"] == "" for i, text in enumerate(texts) if not slow(text))


def test_sanitised_text(docs):
    texts = corpus()[:6] + ["no data here", None, "call +1 (23) 456-7890, 4111 1111 1111 1111!"] + ["zanz zany zap zoo"] * 400 + corpus()[6:]
    table = docs([*enumerate(texts)])
    left = sanitise.sanitised(table)
    assert left.columns == table.columns
    text = {r["doc_id"]: r["text"] for r in left.collect()}
    for i in range(6):
        assert "[email]" in text[i] and MAIL not in text[i] and " zanz*, " in text[i].replace("Zan", "zan") or " zan*, " in text[i]
        assert text[i].replace("[email]", MAIL).split()[-20:] == texts[i].split()[-20:]
    assert (text[6], text[7], text[8]) == ("no data here", None, "call [phone], [card]!")


def test_removed_where_no_class_is_wide_enough(docs):
    texts = [f"word {i} {'abcdefg'[i] * 2} qqqqqq {MAIL}" for i in range(5)] + ["word other thing"] * 200
    text = {r["doc_id"]: r["text"] for r in sanitise.sanitised(docs([*enumerate(texts)])).collect()}
    assert text[0] == "word 0 aa [term] [email]"


def test_repeated_rows_and_ids(docs):
    rows = [(1, f"mail {MAIL}"), (1, f"mail {MAIL}"), (1, "+1 234 567 890"), (None, f"x {MAIL}"), (None, "1.2.3.4"), (None, "1.2.3.4")]
    found = sorted(((r["doc_id"], r["spans"]) for r in sanitise.personal_data(docs(rows)).collect()), key=str)
    assert found == sorted([(1, "email:5:24")] * 2 + [(1, "phone:0:14"), (None, "email:2:21")] + [(None, "ip:0:7")] * 2, key=str)
    assert sorted((r["text"] for r in sanitise.sanitised(docs(rows)).collect()), key=str) == sorted(["mail [email]"] * 2 + ["[phone]", "x [email]"] + ["[ip]"] * 2)


def test_no_rows(docs):
    assert sanitise.personal_data(docs([])).collect() == []
    assert sanitise.sanitised(docs([])).collect() == []


def test_native_plan(spark, docs):
    plan = sanitise.personal_data(docs([(1, MAIL)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = queries.op13_personal_data(spark, sf).collect()
    assert len(found) == len(texts) and any(r["spans"] for r in found)
    for row in found:
        checked(row, texts[row["doc_id"]])
