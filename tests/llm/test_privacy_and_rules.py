"""Personal data, secrets and quality rules against plain versions."""

import math
import random
import re

import pytest
from demandlens.llm import catalog, cascade, disclosure, guess_cost
from pyspark.sql import functions as F


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(text):
    found = []
    for kind, pattern, keep in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) < 256 for p in m.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15)):
        found += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if keep(m[0])]
    return found


PII = ["", None, "a@b", "a@b.c%x@d.e", "x@y.z@w.q", "é a.b+c@d-e.f.g. a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1",
       "4111 1111 1111 1111-2 4111-1111-1111-1111", "+1 (555) 555-1234, +12 +1 2 3 ( 45678", "12345678901234567890",
       "a" * 20000, "1" * 20000, "+1" + "(" * 20000, "1.1.1.1 " * 300, "9.9.9.9@x.y +4915112345678."]


def test_base_spans_equal_the_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(PII)), "doc_id int, text string")
    for r in docs.select("text", disclosure.base_spans(F.col("text")).alias("s")).collect():
        assert [tuple(x) for x in r.s] == base(r.text or ""), (r.text or "")[:60]


def gossip(spark):
    when = ["today", "later", "again", "maybe"]
    rows = [(i, f"word{chr(97 + i) * 5} please write to Zorblax {when[i % 4]} alice@example.com or {chr(98 + i) * 6} things")
            for i in range(6)]
    rows += [(100 + i, f"please write plain things number {i} bob{i}@mail.org") for i in range(20)]
    rows += [(200, "only Zorblax here, zorblaxes not"), (201, None), (202, ""), (0, "a repeated id with Zorblax")]
    return spark.createDataFrame(rows, "doc_id int, text string")


def test_disclosing_terms_are_marked_everywhere(spark):
    docs = gossip(spark)
    terms = {r.term: r.disclosure for r in disclosure.disclosing_terms(docs).collect()}
    assert "zorblax" in terms and not {"please", "write", "things"} & set(terms)
    found = {(r.doc_id, r.text): [tuple(s) for s in r.spans] for r in disclosure.find(docs).collect()}
    assert len(found) == docs.count()
    assert ("term", 5, 12) in found[200, "only Zorblax here, zorblaxes not"] and found[201, None] == []
    assert any(s[0] == "term" for s in found[0, "a repeated id with Zorblax"])
    for (_, text), spans in found.items():
        assert [s for s in spans if s[0] != "term"] == base(text or "")


def test_copies_are_no_evidence(spark):
    docs = spark.createDataFrame([(i, "call Zorblax now alice@example.com please") for i in range(50)], "doc_id int, text string")
    assert disclosure.disclosing_terms(docs) is None
    assert disclosure.find(docs.limit(0)).count() == 0


def test_one_long_document_is_one_document(spark):
    many = " ".join(f"common {chr(97 + i % 26) * 5}{chr(97 + i // 26) * 5} ann@example.com" for i in range(60))
    rows = [(0, many)] + [(i, f"common text {i}" if i < 40 else f"plain text {i}") for i in range(1, 200)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    terms = disclosure.disclosing_terms(docs)
    assert terms is None or "common" not in {r.term for r in terms.collect()}
    found = {r.doc_id: [s.kind for s in r.spans] for r in disclosure.find(docs).collect()}
    assert found[0].count("email") == 60 and found[7] == []


def test_terms_count_over_whole_documents(spark):
    def filler(i, n=40):
        return " ".join(f"{chr(97 + (i * k) % 26)}{chr(97 + (i + k) % 26)}filler" for k in range(n))

    rows = [(i, f"Kim Quorvex {filler(i)} mail to ann@example.com") for i in range(5)]  # far from the find, and short
    rows += [(10 + i, f"near {filler(i)}") for i in range(30)]
    # met in four windows, held by nine documents more: of 13 with the term 13 hold the entity
    rows += [(50 + i, f"Velmora {chr(97 + i) * 5} bob@example.com") for i in range(4)]
    rows += [(60 + i, f"velmora {filler(i)} bob@example.com {filler(i + 3)}") for i in range(9)]
    rows += [(100 + i, f"plain {filler(i)}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    terms = {r.term: r.disclosure for r in disclosure.disclosing_terms(docs).collect()}
    assert terms["kim"] == pytest.approx(1) and terms["quorvex"] == pytest.approx(1) and terms["velmora"] == pytest.approx(1)
    assert not {"plain", "near"} & set(terms)


def plain_terms(rows, least=3, threshold=0.75):
    """Degree per term by definition: every entity against every term."""
    windows, owners, held, content = {}, {}, {}, {}
    for i, text in rows:
        terms = set(re.findall("[a-z]+", text.lower()))
        content[i] = frozenset(terms)
        for t in terms:
            held.setdefault(t, set()).add(i)
        finds = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)]
        cuts = [0, *[x for f in finds for x in f], len(text)]
        for k, (a, b) in enumerate(finds):
            left, right = text[cuts[2 * k]:a].lower()[-160:], text[b:cuts[2 * k + 3]].lower()[:160]
            words = [w for p in ("[a-z]{4,}", "[a-z]+") for w in re.findall(p, left)[-6:] + re.findall(p, right)[:6]]
            owners.setdefault(text[a:b].lower(), set()).add(i)
            for w in words:
                windows.setdefault((text[a:b].lower(), w), set()).add(tuple(words))
    out, total = {}, len(rows)
    for entity, docs in owners.items():
        for t, holders in held.items():
            both = docs & holders
            if both and len(docs) < total:
                degree = math.log2(len(both) / len(holders) * total / len(docs)) / math.log2(total / len(docs))
                enough = len({content[i] for i in both}) >= least or len(windows.get((entity, t), ())) >= least
                if enough and degree >= threshold:
                    out[t] = max(out.get(t, 0), degree)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_terms_equal_brute_force(spark, seed):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefgh", k=draw.choice([2, 3, 5, 6]))) for _ in range(60)]
    people = [f"p{k}@mail.org" for k in range(6)]
    rows = []
    for i in range(90):
        text = draw.choices(words, k=draw.randint(3, 25))
        who = draw.randrange(12)
        if who < 6:
            for _ in range(draw.choice([1, 1, 2, 5])):
                text.insert(draw.randint(0, len(text)), people[who])
                text.insert(draw.randint(0, len(text)), "zed" + "abcdef"[who] * 3)
        if who < 6 and draw.random() < 0.8 or draw.random() < 0.03:
            text.append("kim" + "abcdef"[who % 6])
        rows.append((i, " ".join(text)))
    rows += [(100 + i, rows[5][1]) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found = disclosure.disclosing_terms(docs)
    got = {} if found is None else {r.term: r.disclosure for r in found.collect()}
    assert got == {t: pytest.approx(d) for t, d in plain_terms(rows).items()} and got


def test_sanitise(spark):
    docs = gossip(spark).withColumn("spans", F.lit(1)).withColumn("terms", F.lit("t"))
    out = disclosure.sanitise(docs)
    assert out.columns == docs.columns
    text = {r.doc_id: r.text for r in out.where("doc_id > 100").collect()}
    assert text[201] is None and text[202] == "" and "orblax " not in text[200] and "[EMAIL]" in text[101]


RANKS = {b"password": 1, b"dragon": 2, b"monkey": 30}


def test_cheap_and_costly_values():
    cost = {v: guess_cost.guesses(v, RANKS) for v in (b"password", b"P4ssw0rd", b"dragon1987", b"qwertyuiop", b"zzzzzzzzzz",
                                                      b"19840229", b"xK9$mQ2!vT", b"04dbebab91ab85687d33")}
    assert max(cost[v] for v in (b"password", b"P4ssw0rd", b"dragon1987", b"qwertyuiop", b"zzzzzzzzzz", b"19840229")) < 7
    assert min(cost[b"xK9$mQ2!vT"], cost[b"04dbebab91ab85687d33"]) > guess_cost.THRESHOLD
    assert guess_cost.guesses(b"", RANKS) == 0 and guess_cost.guesses(b"a" * 50000, RANKS) < 10


def test_segmentation_is_the_cheapest():
    """Against all ways to cut a short value into known words and single characters."""
    ranks = {b"abc": 3, b"bcd": 9, b"cab": 100}

    def cheapest(value):
        best = {0: [(0.0, False)]}
        for end in range(1, len(value) + 1):
            options = []
            for cost, brutal in best[end - 1]:
                options.append((cost + guess_cost.brute(value[end - 1]) + (0 if brutal else guess_cost.JOINT), True))
            for word, rank in ranks.items():
                if value[:end].endswith(word):
                    import math
                    options += [(cost + math.log10(rank + 1) + guess_cost.JOINT, False) for cost, _ in best[end - 3]]
            best[end] = [min(o for o in options if o[1] == b) for b in (False, True) if any(o[1] == b for o in options)]
        return min(best[len(value)])[0]

    for value in (b"abcd", b"cabcd", b"xabcx", b"bcdcab", b"cabcdx"):
        assert guess_cost.guesses(value, ranks) <= cheapest(value) + 1e-9


def every_split(value, ranks):
    """The cheapest of all ways to cut a value into spans of every kind."""
    low, size, joint = value.lower(), len(value), guess_cost.JOINT
    date = r"(19|20)\d\d[-/.]?(0[1-9]|1[0-2])[-/.]?(0[1-9]|[12]\d|3[01])|(0[1-9]|[12]\d|3[01])[-/.]?(0[1-9]|1[0-2])[-/.]?(19|20)\d\d"

    def spans(a, b):
        part, own = low[a:b], low[a:b].decode()
        for word, extra in ((part, 0.0), (part.translate(guess_cost.LEET), 0.6)):
            if word in ranks and (not extra or word != part):
                yield math.log10(ranks[word] + 1) + extra + (0.3 if value[a:b] != part else 0)
        if re.fullmatch(r"(19|20)\d\d", own):
            yield guess_cost.YEAR
        if re.fullmatch(date, own):
            yield guess_cost.DAY
        if b - a >= 3 and len(set(part)) == 1:
            yield guess_cost.brute(value[a]) + math.log10(b - a)
        if b - a >= 3 and all(y in guess_cost.NEAR.get(x, ()) for x, y in zip(part, part[1:])):
            yield math.log10(47 * (b - a)) + 0.3 * min(sum(abs(x - y) != 1 for x, y in zip(part, part[1:])), 8)
        for length in range(2, (b - a) // 2 + 1):
            if (b - a) % length == 0 and part == part[:length] * ((b - a) // length):
                yield every_split(value[a:a + length], ranks) + math.log10((b - a) // length)

    best, single = [0.0], [math.inf]
    for end in range(1, size + 1):
        single.append(guess_cost.brute(value[end - 1]) + min(best[-1] + joint, single[-1]))
        best.append(min([single[-1]] + [best[a] + c + joint for a in range(end) for c in spans(a, end)]))
    return best[size]


def test_segmentation_with_all_spans():
    ranks = {b"password": 1, b"dragon": 2, b"ddd": 50, b"abc": 7, b"fgh": 300, b"lad": 30}
    values = [b"passwordddddddddd", b"passwordfghjkl", b"abc123abc123", b"20001999", b"31121999", b"19840229000000", b"Passw0rdDDDDD",
              b"qwertrewqwertrewqazsdcftgb", b"ladddddfghjjjjjabcabcabcabc", b"ababababab", b"xdddxdddxddd"]
    draw = random.Random(3)
    pieces = [b"password", b"dragon", b"ddd", b"dddddd", b"abc", b"fghjkl", b"qwe", b"1999", b"x7", b"D", b"0229", b"asd", b"4"]
    values += [b"".join(draw.choice(pieces) for _ in range(draw.randrange(1, 6))) for _ in range(150)]
    values += [bytes(draw.choice(b"asdw1") for _ in range(draw.randrange(1, 24))) for _ in range(150)]
    for value in values:
        assert guess_cost.guesses(value, ranks) == pytest.approx(every_split(value, ranks), abs=1e-9), value
    for weak in values[:3]:
        assert guess_cost.guesses(weak, ranks) < 8


def test_long_values_cost_linear_time():
    for unit in (b"a", b"ab", b"qw", b"qwertrew", b"abc123", bytes(range(40, 80))):
        assert guess_cost.guesses(unit * (20000 // len(unit)), RANKS) > 0


SECRETS = [(1, 'é token = "abcdef"'), (2, "PassWord:abc"), (3, "my pwd is xK9$mQ2!vT."), (4, "AKIA" + "A" * 16 + " AKIAB"),
           (5, "deadbeef" * 3 + "g" + "a" * 23), (6, None), (7, ""), (8, "ſecret=abcdefgh"), (9, "api_key api-key apikey=xyz123"),
           (10, "pwd: dragon"), (1, "x" * 100000)]


def test_secret_spans(spark):
    docs = spark.createDataFrame(SECRETS, "doc_id int, text string").withColumn("secrets", F.lit(0))
    out = guess_cost.secrets(docs, ranks=RANKS)
    got = sorted([(r.doc_id, [(s.kind, s.start, s.end) for s in r._secrets]) for r in out.collect()])
    assert got == [(1, []), (1, [("assign", 2, 17)]), (2, []), (3, [("guess", 10, 21)]), (4, [("access", 0, 20)]), (5, [("hex", 0, 24)]),
                   (6, []), (7, []), (8, []), (9, [("assign", 16, 29)]), (10, [])]


def guessed(text):
    return [text[a:b].decode() for k, a, b, _ in guess_cost.find(text, RANKS) if k == "guess"]


def test_values_are_priced_whole():
    secret = "Dragon!vQ9#kT2$wZ"
    for before in ("password: ", "pwd: ", "api_key='", "mytoken="):
        assert guessed(f"é {before}{secret}, and more".encode()) == [secret]
    assert guess_cost.find(b"password: Dragon!vQ9#kT2$wZ", RANKS)[0][:3] == ("assign", 0, 16)
    assert guessed(b"token=a!vQ9#kT2$wZ pwd:token=xK9$mQ2!vT") == ["a!vQ9#kT2$wZ", "token=xK9$mQ2!vT"]
    assert guessed(b"secret: password = xK9$mQ2!vT") == ["xK9$mQ2!vT"]
    assert guessed(b"password: dragon!monkey") == [] and len(guessed(b"token=" * 9000 + b"x")) <= 1


def test_context_names_are_parts_of_identifiers():
    secret = "xK9$mQ2!vT"
    for name in ("aws_secret_access_key = ", "SECRET_KEY=", "MYSQL_PWD=", "db_pwd: ", "my_private_key=", "--db-pwd=", "x-api-key: ",
                 "db_password_prod: '", "\"client_secret_value\": \"", "__pwd__=", "db_pwd is ", "pwd_2 is ", "pass-pwd is ", "api_key: ", "_bearer ",
                 "pwd_pwd_key="):
        assert guessed(f"é ({name}{secret}".encode()) == [secret], name
    for name in ("spinpin: ", "compass_rose: ", "pinned_at: ", "access: ", "pwd-less is ", "mypwd=", "pwd5="):
        assert guessed(f"{name}{secret}".encode()) == [], name
    for long in (b"pwd_" * 50000, b"pwd-" * 50000, b"a_" * 50000 + b"pwd", b"-" * 100000, b"pwd" + b" " * 100000):
        assert guessed(long + b"+") == [] and guessed(b"pwd +" + long) == []


def test_dictionary_counts_all_texts(spark):
    docs = spark.createDataFrame([("b B, a",), ("bbb aaa bbb AAA. bbb",), (None,), ("ccc ccc",)], "text string")
    assert guess_cost.dictionary(docs, size=2) == {b"bbb": 1, b"aaa": 2}


def repeat_words(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    return len({p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)})


TEXTS = ["", None, " \n ", "a b c d e f g h i j k", "a b c d e a b c d e", "a a a a a a a", "x\n x\nx\n\n\n", "#*$ %&| <>",
         "one two three four five six " * 4, "\tlead and trail \x0b", "É" * 40 + " " + "é" * 30, "w " * 3000,
         "a b c d e x a b c d e y z q a b c d f"]


def test_measures_equal_plain_counts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    names = list(cascade.measures(F.col("text")))
    for rows, figure in ((docs, cascade.measures(F.col("text"))), cascade.measured(docs, "text", names)):
        for r in rows.select("text", *[figure[n].alias(n) for n in names]).collect():
            text = r.text or ""
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words, r.n_letters, r.n_capitals) == (
                len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)),
                repeat_words(words), sum(c.isalpha() for c in text), sum(c.isupper() for c in text)), text[:40]


def test_order_changes_no_verdict(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    conditions = cascade.rules(cascade.measures(F.col("text")))
    one = docs.select("doc_id", cascade.verdict(conditions, list(conditions)).alias("v"))
    two = docs.select("doc_id", cascade.verdict(conditions, list(conditions)[::-1]).alias("v"))
    assert {r.doc_id for r in one.where("v is null").collect()} == {r.doc_id for r in two.where("v is null").collect()}
    out = cascade.apply_rules(docs.withColumn("rejected_by", F.lit(1)))
    assert out.columns[-1] == "_rejected_by" and out.where("_rejected_by is null").count() == one.where("v is null").count()
    assert cascade.apply_rules(docs.limit(0)).count() == 0


def test_cheap_rejecting_rules_come_first(spark):
    docs = spark.range(3000).select(F.concat(F.lit("some words here number "), F.col("id")).alias("text"))
    slow = F.size(F.filter(F.sequence(F.lit(0), F.lit(5000)), lambda i: i % F.length("text") == 7)) < 0
    order = cascade.ordered(docs, {"slow_never": slow, "fast_always": F.length("text") > 3})
    assert order == ["fast_always", "slow_never"]


def test_rules_run_no_python(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    for frame in (cascade.apply_rules(docs), disclosure.find(docs)):
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString().replace("InPython", ""))


def test_figures_behind_a_rejection_are_not_measured(spark):
    plan = catalog.op10_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    top, _, below = plan.partition("Project [doc_id")[2].partition("Project [doc_id")
    for letters in ("p{L}", "p{Lu}"):
        assert letters in top and letters not in below
        assert top.index("CASE WHEN") < top.index(letters)
