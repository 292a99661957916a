"""Personal data is known by its form, whatever ranges are in use."""

import re

from sessionweave.llm import pii


def test_phones_and_addresses_of_any_range_are_replaced(spark):
    values = ["+1 (017) 555-7713", "(117) 055-7713", "017-155-7713", "+10171557713", "240.56.125.154", "0.0.0.0", "255.255.255.255"]
    rows = [(k, f"see {v}, and {v}.") for k, v in enumerate(values)]
    out = {r.doc_id: (r.text, r.n_pseudonyms) for r in pii.pseudonymize(spark.createDataFrame(rows, "doc_id bigint, text string"), "k").collect()}
    for k, v in enumerate(values):
        first, second = re.fullmatch(r"see (.*), and (.*)\.", out[k][0]).groups()
        assert out[k][1] == 2 and first == second != v
        if v.count(".") == 3:
            assert all(0 <= int(x) < 256 for x in first.split("."))
        else:
            assert re.sub(r"\d", "9", first) == re.sub(r"\d", "9", v)


def test_they_are_permuted_within_their_whole_range(spark):
    from pyspark.sql import functions as F

    n = spark.range(0, 10**10, 10**7 // 3).select(F.format_string("%010d", "id").alias("d"))
    phones = n.select(F.regexp_replace("d", r"(...)(...)(....)", "$1-$2-$3").alias("d")).select(pii.phone("k", F.col("d")).alias("p"))
    assert phones.distinct().count() == n.count()
    octets = spark.range(0, 2**32, 2**20 + 1).select(F.concat_ws(".", *(F.shiftright("id", k).bitwiseAND(255) for k in (24, 16, 8, 0))).alias("d"))
    made = octets.select(pii.ipv4("k", F.col("d")).alias("p"))
    assert made.distinct().count() == octets.count() and made.filter("p is null").count() == 0


def plain_half(key, tag, round_, half):
    import hashlib

    return hashlib.sha256("|".join((key, tag, str(round_), half)).encode()).hexdigest()


def plain_pair(key, tag, a, b, sizes):
    """The Feistel network on pairs of numbers, in plain Python."""
    for r in range(1, pii.ROUNDS + 1):
        if r % 2:
            a = (a + int(plain_half(key, tag, r, str(b))[:14], 16)) % sizes[0]
        else:
            b = (b + int(plain_half(key, tag, r, str(a))[:14], 16)) % sizes[1]
    return a, b


def plain_text(key, tag, text):
    """The same on strings: letters and digits move within their kind."""
    cut = len(text) // 2
    a, b = text[:cut], text[cut:]

    def shift(s, hexa):
        out = []
        for i, c in enumerate(s, 1):
            by = int(hexa[(i % 32) * 2 : (i % 32) * 2 + 2], 16)
            kind = next((x for x in ("09", "az", "AZ") if x[0] <= c <= x[1]), None)
            out.append(c if kind is None else chr((ord(c) - ord(kind[0]) + by) % (ord(kind[1]) - ord(kind[0]) + 1) + ord(kind[0])))
        return "".join(out)

    for r in range(1, pii.ROUNDS + 1):
        if r % 2:
            a = shift(a, plain_half(key, tag, r, b))
        else:
            b = shift(b, plain_half(key, tag, r, a))
    return a + b


def test_pseudonyms_against_plain_python(spark):
    import random

    rng = random.Random(1)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows, want = [], {}
    for k in range(150):
        area, rest = rng.randrange(1000), rng.randrange(10**7)
        x, y = plain_pair("k", "phone", area, rest, (1000, 10**7))
        o = [rng.randrange(256) for _ in range(4)]
        p, q = plain_pair("k", "ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], (65_536, 65_536))
        name = "".join(rng.choice("abcXYZ019._") for _ in range(8)).strip("._") + "q"
        body = digits(15)
        total = lambda d, first: sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 == first else int(c) for i, c in enumerate(reversed(d)))
        card = body + str(-total(body, 0) % 10)
        new = body[0] + plain_text("k", "card", body[1:])
        rows.append((k, f"{area:03}-{rest // 10**4:03}-{rest % 10**4:04} {'.'.join(map(str, o))} {name}@site.org {card} token={'T' + digits(9)}"))
        secret = rows[-1][1].rsplit("=", 1)[1]
        want[k] = " ".join((f"{x:03}-{y // 10**4:03}-{y % 10**4:04}", f"{p // 256}.{p % 256}.{q // 256}.{q % 256}", plain_text("k", "email", f"{name}@site") + ".org", new + str(-total(new, 0) % 10), "token=" + plain_text("k", "secret", secret)))
    got = {r.doc_id: (r.text, r.n_pseudonyms) for r in pii.pseudonymize(spark.createDataFrame(rows, "doc_id bigint, text string"), "k").collect()}
    assert got == {k: (t, 5) for k, t in want.items()}


def test_every_format_is_a_permutation(spark):
    """Different values never share a pseudonym, in every format; and tables without rows stay so."""
    from pyspark.sql import functions as F

    n = spark.range(4000)
    word = F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12)
    makers = {
        pii.email: F.concat(word, F.lit("@mail.example.org")), pii.secret: F.concat(F.lit("password="), word), pii.ssn: F.format_string("%03d-%02d-%04d", F.col("id") % 600 + 1, F.col("id") % 99 + 1, F.col("id") + 1),
    }
    for make, value in makers.items():
        df = n.select(value.alias("v")).distinct()
        assert df.select(make("k", F.col("v")).alias("p")).filter("p is not null").distinct().count() == df.count(), make.__name__
    small = spark.range(1000).select(F.format_string("%03d", "id").alias("t")).select(pii.permute_text("k", "x", F.col("t")).alias("p"))
    assert {r.p for r in small.collect()} == {f"{k:03}" for k in range(1000)}  # the whole range, each once
    assert pii.pseudonymize(spark.createDataFrame([], "doc_id bigint, text string"), "k").count() == 0
