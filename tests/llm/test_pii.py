"""Surrogates: form, coreference, distinctness."""

import re

from tallyline.llm import pii

ROWS = [
    (1, "Write to Ann.Lee+x@Mail3.example.com or ann.lee+x@mail3.example.com, not ben@mail3.example.com."),
    (2, "Call +1 (988) 555-2485, that is +1-988-555-2485; or (415) 555-0199."),
    (3, "Card 4111 1111 1111 1111 and 4111111111111111 and 4041894974608795."),
    (4, "Host 42.144.35.254, version 2.0.1 and 1.2.3.4.5, ip 10.0.0.7."),
    (5, 'password=b7db7aa4a5fcc78305 and token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae"; API_KEY: ZZ-19ab_q'),
    (6, "Dear Mrs. Mary Smith, Mr. Smith and Dr. Ивана Петрова met Frau Müller. John Smith left."),
    (7, "SSN 219-09-9999, IBAN DE89 3704 0044 0532 0130 00."),
    (8, "Nothing here, 12 of 345, a@b, 1.2.3, Version 2.0."),
    (9, None),
    (10, ""),
    (1, "Write to Ann.Lee+x@Mail3.example.com or ann.lee+x@mail3.example.com, not ben@mail3.example.com."),
]


def _replaced(spark, rows=ROWS):
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, sub string, new int")
    out = pii.replace(df)
    assert out.columns == df.columns
    return {r.doc_id: r.text for r in out.collect()}, out.count()


def test_kinds(spark):
    out, n = _replaced(spark)
    assert n == len(ROWS) and [out[i] for i in (8, 9, 10)] == [ROWS[7][1], None, ""]
    found = re.findall(r"\S+@[\w.]+\w", out[1])
    assert found[0] == found[1] != found[2] and found[0].split("@")[1] == found[2].split("@")[1]
    assert "lee" not in out[1].lower() and "mail3" not in out[1] and found[0].endswith(".example.com")
    one, two, three = re.fullmatch(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}), that is (\+1-\d{3}-\d{3}-\d{4}); or (\(\d{3}\) \d{3}-\d{4})\.", out[2]).groups()
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two) != "19885552485" and "555-0199" not in three
    spaced, plain, other = re.fullmatch(r"Card (4\d{3} \d{4} \d{4} \d{4}) and (4\d{15}) and (4\d{15})\.", out[3]).groups()
    assert spaced.replace(" ", "") == plain != "4" + "1" * 15
    luhn = lambda s: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10
    assert luhn(plain) == 0
    hosts = re.findall(r"\d+\.\d+\.\d+\.\d+", out[4])
    assert "42.144.35.254" not in out[4] and "10.0.0.7" not in out[4] and "1.2.3.4.5" in out[4] and len(set(hosts)) == 3
    secrets = re.fullmatch(r'password=([0-9a-f]{18}) and token = "([0-9a-f]{40})"; API_KEY: ([A-Z]{2}-\d{2}[a-z]{2}_[a-z])', out[5])
    assert secrets and "b7db7aa4" not in out[5] and "1beb58" not in out[5]
    smith = re.fullmatch(r"Dear Mrs\. (\S+) (\S+), Mr\. (\S+) and Dr\. (\S+) (\S+) met Frau (\S+)\. (\S+) (\S+) left\.", out[6]).groups()
    assert smith[1] == smith[2] == smith[7] != "Smith" and len(set(smith)) == 6
    assert set(smith[0].split("-")) <= set(pii.NAMES["latin", "f"]) and set(smith[6].split("-")) <= set(pii.NAMES["latin", "m"])
    assert re.fullmatch(r"[а-яё]+", smith[4].lower()) and "219-09-9999" not in out[7]
    assert re.fullmatch(r"SSN \d{3}-\d{2}-\d{4}, IBAN DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d\.", out[7])


def test_same_key_same_result_other_key_another(spark):
    df = spark.createDataFrame(ROWS[:7], "doc_id long, text string")
    a, b, c = (sorted(map(tuple, pii.replace(df, key=k).collect())) for k in ("k", "k", "z"))
    assert a == b and all(x[1] != y[1] for x, y in zip(a, c))


def test_surrogates_stay_distinct(spark):
    people = "abcdefghijklmnopqrstuvwxyz"
    texts = [f"Mrs. Mary {x.upper()}{y}m met 1.1.{i}.{j}" for i, x in enumerate(people) for j, y in enumerate(people)]
    out, _ = _replaced(spark, list(enumerate(texts)))
    parts = [re.fullmatch(r"Mrs\. (\S+) (\S+) met (\S+)", t).groups() for t in out.values()]
    assert len({p[1] for p in parts}) == len({p[2] for p in parts}) == len(texts) and len({p[0] for p in parts}) == 1
    assert not {p[2] for p in parts} & {t.split()[-1] for t in texts}


def test_plan_is_native_and_empty_table(spark):
    empty = pii.replace(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0
    plan = pii.replace(spark.createDataFrame(ROWS, "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_marks_in_a_text(spark):
    text = "\ue000\ue001 a@b.example.org \ue000"
    out, _ = _replaced(spark, [(1, text), (2, "x " * 200_000 + "q@z.example.net")])
    assert out[1].startswith(text[:3]) and out[1].endswith(text[-2:]) and "a@b" not in out[1]
    assert out[2].startswith("x " * 1000) and "q@z" not in out[2] and out[2].endswith(".example.net")


def test_more_entities_than_forms(spark):
    from itertools import product

    phones = [f"+1{i:04d}" for i in range(1000, 7000)]  # 10,000 forms, of which 4,000 are free
    names = ["".join(x) for x in product("αεηιοω", repeat=4)][:400]  # 340 forms of at most four parts
    texts = [f"Call {p}." for p in phones] + [f"Dr. Α{x} Πέτρου spoke." for x in names] + ["token=......"]
    out, n = _replaced(spark, list(enumerate(texts)))
    new = [re.fullmatch(r"Call (\+1\d{4,})\.", out[i]).group(1) for i in range(len(phones))]
    assert n == len(texts) and len(set(new)) == len(phones) and not set(new) & set(phones)
    given = {re.fullmatch(r"Dr\. (\S+) \S+ spoke\.", out[i + len(phones)]).group(1) for i in range(len(names))}
    assert len(given) == len(names) and out[len(texts) - 1] != texts[-1]


def test_further_forms_are_found(spark):
    secrets = ["db_password=hunter2hunter2", "access_token: abc123abc123", "client_secret=zz99zz99", "AWS_SECRET_ACCESS_KEY=AKIA12345678", "dbPassword=qwerty12"]
    hosts = ["2001:db8::1", "fe80::1a2b:3", "2001:db8:7::"]
    phones = ["415 555 0199", "1-415-555-0199", "1 (415) 555-0198"]
    people = ["г-н Смирнов", "Иван Кузнецов", "г-жа Орлова", "Μαρία Παππά", "κ. Παπαδόπουλος", "κυρία Ιωάννου"]
    forms = secrets + hosts + phones + people
    plain = ["std::vec", "face::bed", "at 12:30:45 sharp", "Иван пришёл.", "the secret of 1000 years"]
    out, _ = _replaced(spark, list(enumerate([f"See {x} there" for x in forms] + plain)))
    for i, x in enumerate(forms):
        new = re.fullmatch(r"See (.*) there", out[i]).group(1)
        assert new != x, x
        if x in secrets:
            key, value = re.fullmatch(r"(\S*?[=:] ?)(\S+)", x).groups()
            assert new.startswith(key) and value not in new
        elif x in phones:
            assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", x) and new.startswith("1") >= x.startswith("1")
        elif x in people:
            assert x.split()[-1] not in new and not re.search("[A-Za-z]", new)
    assert [out[len(forms) + i] for i in range(len(plain))] == plain


def test_long_runs_of_each_alphabet(spark):
    """100,000 characters that a pattern's parts can match, with and without an end that fits."""
    runs = {
        "secret": "password=" + "Ab1+/_-." * 12_500, "key": "api_key" + ".x" * 50_000 + "=abcdefgh",
        "email": "a@" + "b." * 50_000, "email ends": "a@" + "b." * 50_000 + "com", "local": "a." * 50_000 + "@b.com",
        "person": "Mr. " + "Ab-Cd Ef " * 11_000, "one name": "Mr. A" + "b" * 100_000, "apostrophes": "Dr. A" + "’b" * 50_000,
        "iban": "DE89 " + "3704 " * 20_000, "iban plain": "DE89" + "A1B2" * 25_000, "ipv6": "a1:" * 33_000, "ipv6 gap": "::1" * 33_000,
        "ip": "1.2.3.4." * 12_500, "ssn": "219-09-9999-" * 8_000, "phone": "+1 (415) " + "555 " * 25_000, "card": "4 " * 50_000,
        "spaces": "+1" + " " * 100_000 + "2", "digits": "7" * 100_000, "titles": "Mr. " * 25_000, "blanks": "token" + " " * 100_000 + "=",
    }
    rows = list(enumerate(runs.values()))
    out, n = _replaced(spark, rows)
    assert n == len(runs)
    assert "Ab1+/_-." * 100 not in out[0] and out[2] == runs["email"] and out[17] == runs["digits"]
