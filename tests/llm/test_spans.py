"""Secrets, personal data and page text against brute force."""

import hashlib
import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from reachmap.llm import html_main, pii, secrets

from .helpers import documents, odd_rows, words

KEY = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = re.compile(KEY + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_secrets(text):
    s = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    s += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    s += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(s, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


def hexadecimal(r, n=40):
    return "".join(r.choice("0123456789abcdef") for _ in range(n))


def secret_rows(n=300):
    rows = []
    for i in range(n):
        r = random.Random(i)
        w = words(40, i)
        for _ in range(i % 3):
            mixed = "".join(r.choice("ABCDEFGHabcdefgh0123456789") for _ in range(20))
            w.insert(r.randrange(len(w)), r.choice([
                f'token = "{hexadecimal(r)}"', f"API_Key: {mixed}", f"passwd='{mixed}'", "secret=short", f"AKIA{mixed.upper()}",
                hexadecimal(r, 31), "AKIAAKIA", "tokens == x", "Key token:=abcdefghij", f"TOKEN\n= {mixed}", "😀 password = pässwörter12",
            ]))
        rows.append((i, " ".join(w).replace(" a", "\na")))
    return rows


def test_secret_base_spans_and_field(spark):
    rows = secret_rows() + [(1000 + (i or 0), t) for i, t in odd_rows()]
    got = secrets.scan_secrets(documents(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    of = {}
    for i, t in rows:
        of.setdefault(i, t or "")
    for r in got:
        want = brute_secrets(of[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in want) for k in ("assign", "access", "hex"))
        assert set(joined.split(",")) <= set(r.spans.split(","))


def test_field_finds_unseen_secrets():
    """Decoded without the patterns on rows not trained on."""
    rows = secret_rows(600)
    model = secrets.fit(secrets.training_sequences([t for i, t in rows if i % 5]))
    found = total = false = 0
    for i, t in rows:
        if i % 5 == 0:
            mine = secrets.field_spans(t, model)
            gold = [s for s in brute_secrets(t) if s[0] == "assign" and secrets.telling(ASSIGN.match(t, s[1]).group(2))]
            total += len(gold)
            found += sum(any(a < e and s < b for _, s, e in mine) for _, a, b in gold)
            false += sum(not any(a < e and s < b for _, a, b in brute_secrets(t)) for _, s, e in mine)
    assert total > 30 and found >= 0.85 * total and false <= 0.2 * total
    assert secrets.field_spans('a token is "aB3dE5gH7jK9mN1pQ3s5" here', model)
    assert not secrets.field_spans("plain words and 12 numbers in 2024 only", model)


def test_secrets_of_any_shape_can_be_found():
    """Secrets that begin with plain letters, capitals or short digits, in surroundings that no pattern has."""

    def text(i):
        r = random.Random(i)
        w = lambda n, a="abcdefghijklmnopqrstuvwxyz": "".join(r.choice(a) for _ in range(n))
        value = [w(15), w(14, "QWERTZUIOP"), f"{r.randrange(1000, 9999)}-{r.randrange(1000, 9999)}", f"{w(2)}/{w(3)}0{w(5)}+{w(3)}"][i % 4]
        key = r.choice(["password: ", "api_key: ", "secret=", "token = "])
        return "\n".join([" ".join(w(r.randint(2, 8)) for _ in range(12)), key + value, "plain " + w(5)])

    model = secrets.fit(secrets.training_sequences([text(i) for i in range(400)]))
    lines = ["passphrase: correcthorsebattery", "client_key: QWERTZUIOPASDF", "pin=4711-0815", "pwd = kq/jsl0wptzy+ydd"]
    got = [[t[a:b] for _, a, b in secrets.field_spans(t, model)] for t in lines]
    assert got == [["correcthorsebattery"], ["QWERTZUIOPASDF"], ["4711-0815"], ["kq/jsl0wptzy+ydd"]]


def test_decoding_all_lines_at_once_equals_each_line():
    import numpy as np

    r = np.random.default_rng(3)
    for _ in range(50):
        e, t = r.normal(size=(60, 3)) * 2 + [r.uniform(0, 5), 0, 0], r.normal(size=(3, 3))
        line = np.sort(r.integers(0, 12, 60))
        want = []
        for k in np.unique(line):
            at = np.flatnonzero(line == k)
            tags = "".join(map(str, secrets.viterbi(e[at], t)))
            want += [(at[m.start()], at[m.end() - 1]) for m in re.finditer("12*", tags)]
        assert secrets.decoded(e, line, t) == want


def test_viterbi_equals_all_paths():
    import itertools

    import numpy as np

    r = np.random.default_rng(2)
    for _ in range(20):
        e, t = r.normal(size=(5, 3)), r.normal(size=(3, 3))
        best = max(
            (p for p in itertools.product(range(3), repeat=5) if p[0] != 2 and all((a, b) != (0, 2) for a, b in zip(p, p[1:]))),
            key=lambda p: sum(e[i, y] for i, y in enumerate(p)) + sum(t[a, b] for a, b in zip(p, p[1:])),
        )
        assert secrets.viterbi(e, t) == list(best)


def test_secrets_without_rows(spark):
    assert secrets.scan_secrets(documents(spark, [])).count() == 0
    assert secrets.scan_secrets(documents(spark, odd_rows())).count() == len(odd_rows())


def luhn(s):
    t = 0
    for i, c in enumerate(reversed(s)):
        x = int(c) * (1 + i % 2)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def holds(kind, v):
    digits = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    return {"email": True, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def pii_rows(n=200):
    rows = []
    for i in range(n):
        r = random.Random(i)
        number = "".join(r.choice("0123456789") for _ in range(15))
        card = next(number + d for d in "0123456789" if luhn(number + d))
        w = words(20, i)
        for _ in range(i % 4):
            w.insert(r.randrange(len(w)), r.choice([
                f"mail.{i}@host-{i}.example.com", "a@b.c_d@e.f.g", "a@b@c.d", ".%x@c.com.", f"10.0.{i}.7", "1.2.3.4.5.6.7.8", "300.1.1.1",
                "0255.1.1.01", card, f"{card[:4]} {card[4:8]}-{card[8:12]} {card[12:]}", card[:-1], card + "00000", "12-34", "+1 (555) 010-9999",
                "+12", "+123-456.7890 ()", "😀é x@y.zz", f"({r.randrange(100, 999)}) 555-{r.randrange(1000, 9999)}",
            ]))
        rows.append((i, " ".join(w)))
    return rows


def test_personal_data_base_spans(spark, monkeypatch):
    rows = pii_rows() + [(1000 + (i or 0), t) for i, t in odd_rows()]
    found = pii.find_personal_data(documents(spark, rows, extra=True)).collect()
    assert len(found) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t or "")
    for r in found:
        t = texts[r.doc_id]
        want = [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, t) if holds(k, m.group())]
        assert [tuple(s) for s in r.base] == want, t
        for s in r.added:  # inside the text and free of base spans
            assert 0 <= s.start < s.end <= len(t) and not any(s.start < b and a < s.end for _, a, b in want)


def test_obfuscated_addresses_are_proposed_without_an_at_sign(spark):
    whole = "john.doe{}example.com"
    marks = ["(at)", "[at]", "(at]", "[at)", "@"]
    rows = [(i, "write to " + whole.format(m)) for i, m in enumerate(marks)] + [(9, "meet at (the) place")]
    got = {r.doc_id: r.proposals for r in pii.spans_of(documents(spark, rows)).collect()}
    assert all([(p.start, p.end) for p in got[i]] == [(9, len(t))] for i, t in rows[:-1]) and got[9] == []


def test_long_runs_stay_linear(spark):
    rows = [(1, "x" * 300_000 + " a@b.cd"), (2, "7" * 200_000 + ".1.2.3"), (3, "+" + "1 " * 100_000)]
    got = {r.doc_id: r.base for r in pii.find_personal_data(documents(spark, rows)).collect()}
    assert [tuple(s) for s in got[1]] == [("email", 300_001, 300_007)] and got[2] == [] and got[3] == []


def personal_text(i):
    """A text with one base span, and its parts for other forms."""
    r = random.Random(i)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    card = next(c for c in (number(15) + d for d in "0123456789" * 50) if luhn(c))
    mail = (words(1, i)[0] + "." + number(2), words(1, i + 1)[0] + ".example.com")
    phone = ("49", f"{r.randrange(150, 180)} {number(3)}-{number(4)}")
    octets = [str(r.randrange(256)) for _ in range(4)]
    return mail, phone, card, octets, " ".join(words(6, i)), " ".join(words(6, i + 5))


def test_planted_forms_that_no_pattern_has_are_added(spark):
    rows, planted = [], {}
    for i in range(400):
        mail, phone, card, octets, before, after = personal_text(i)
        value = ["@".join(mail), f"+{phone[0]} {phone[1]}", card, ".".join(octets)][i % 4]
        rows.append((i, f"{before} {value} {after} on 2023-0{i % 9 + 1}-12 at 10:15:{i % 50 + 10} no 77{i:05d}"))
    for i in range(1000, 1080):
        mail, phone, card, octets, before, after = personal_text(i)
        fours = [card[k : k + 4] for k in range(0, 16, 4)]
        forms = [
            "(at)".join(mail), f"{mail[0]} at {mail[1].replace('.', ' dot ')}", f"00{phone[0]} {phone[1]}", ".".join(fours),
            " - ".join(fours), "[.]".join(octets), "(.)".join(octets), f"0{phone[1]}",
        ]
        planted[i] = (len(before) + 1, len(before) + 1 + len(forms[i % 8]))
        rows.append((i, f"{before} {forms[i % 8]} {after}"))
    got = pii.find_personal_data(documents(spark, rows)).collect()
    hit = sum(any(s.start < planted[r.doc_id][1] and planted[r.doc_id][0] < s.end for s in r.added) for r in got if r.doc_id in planted)
    false = sum(len(r.added) for r in got if r.doc_id not in planted)
    assert hit >= 0.8 * len(planted) and false <= 0.05 * len(rows), (hit, false)


def test_rewritten_spans_are_proposals_and_no_base_spans(spark):
    rows = [("email", "ann.lee@mail.example.com"), ("phone", "+1 (415) 555-0123"), ("card", "4111111111111111"), ("ip", "10.20.30.40")]
    df = spark.createDataFrame(rows, "kind string, v string").select("kind", F.explode(pii.rewritten(F.col("kind"), F.col("v"))).alias("f"))
    forms = [(r.kind, r.f.value, r.f.label) for r in df.collect()]
    assert {k for k, _, label in forms if label == 1} == set(PII)
    for kind, v, label in forms:
        if label == 1:
            assert not any(holds(k, m.group()) for k, p in PII.items() for m in re.finditer(p, v)), v
    good = [v for _, v, label in forms if label == 1]
    got = pii.spans_of(documents(spark, [(i, f"x {v} y") for i, v in enumerate(good)])).collect()
    assert all(any(p.value == good[r.doc_id] for p in r.proposals) for r in got)


def test_pii_learns_from_every_span_and_proposal(spark, monkeypatch):
    """Twice the texts are twice the weight of the training rows, none is left out."""
    monkeypatch.setattr(pii, "TRAIN_ROWS", 10, raising=False)
    texts = [t for _, t in pii_rows(40)]

    def weight(times):
        docs = documents(spark, [(i, t) for i, t in enumerate(texts * times)])
        spans = pii.spans_of(docs).persist()
        rows = pii.training_rows(spans, pii.free_proposals(spans))
        return rows.filter("label = 0").agg(F.sum("weight")).first()[0]

    once = weight(1)
    assert once > 40 and weight(3) == 3 * once


def test_free_proposals_equal_all_pairs(spark):
    rows = pii_rows() + [(500, "+1 (555) 010-9999 " * 40 + "555 123-4567 " * 40), (501, None)]
    spans = pii.spans_of(documents(spark, rows)).persist()
    want = []
    for r in spans.collect():
        want += [(r.doc_id, p.generator, p.start, p.end) for p in r.proposals if not any(b.start < p.end and p.start < b.end for b in r.base)]
    got = [(r.doc_id, r.generator, r.start, r.end) for r in pii.free_proposals(spans).collect()]
    assert sorted(got) == sorted(want) and want
    places = {i: t for i, t in rows}
    assert all(places[r.doc_id][s.start : s.end] == s.value for r in spans.collect() for s in r.base + r.proposals)


def test_very_many_matches_in_one_text(spark):
    text = " ".join(f"a{i}@b.example tel 030 {i:07d}" for i in range(50_000))
    begin = time.perf_counter()
    got = pii.find_personal_data(documents(spark, [(1, text), *pii_rows()])).filter("doc_id = 1").collect()
    want = [m.span() for m in re.finditer(PII["email"], text)]
    assert {(s.start, s.end) for r in got for s in r.base if s.kind == "email"} >= set(want) and len(want) == 50_000
    assert time.perf_counter() - begin < 90


def test_redaction(spark):
    df = spark.createDataFrame([("a x@y.zz b 😀 10.0.0.1!",)], "text string").withColumn(
        "spans", F.expr("array(struct('ip' kind, 13 start, 21 end), struct('email' kind, 2 start, 8 end), struct('model' kind, 4 start, 9 end))")
    )
    # what the overlapping span adds goes as well
    assert df.select(pii.redacted(F.col("text"), F.col("spans"))).first()[0] == "a [email]b 😀 [ip]!"
    assert pii.find_personal_data(documents(spark, [])).count() == 0


def page(body, host="h.example"):
    return f"https://{host}/p", f"<!DOCTYPE html><html><head><title>t</title></head><body class='has-sidebar'>{body}</body></html>"


def texts(spark, pages, **options):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = html_main.extract(df.withColumn("host", F.lit("x")).withColumn("templates", F.lit("y")), **options).collect()
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(pages)
    return {r.page_id: r.text for r in got}


def test_page_text(spark):
    body = (
        "<header><a>Site</a></header><nav><ul><li>menu</ul></nav><div class='side-bar ad'>buy</div>"
        "<article><header><h1>Title &amp; more</h1></header><p>One <b>two\n three<br>four</b><p>Five&nbsp;six &lt;x&gt; &#8212;"
        "<script>if (a<b) p('</p>')</script><ul><li>a<li>b</ul><!-- no --><aside>aside</aside><form>f</form>"
        "<div id=comments><p>first!</div></article><section class='comments'>c</section><footer>end</footer>"
    )
    plain = "<div><p>No article here</p><div class=cookie-notice>accept</div><p>but text</div><footer>f</footer>"
    got = texts(spark, [page(body), page(plain), (None, None), ("no url", ""), page("<p>a &am b &amp c")])
    assert got[0] == "Title & more\nOne two three four\nFive six <x> —\na\nb"
    assert got[1] == "No article here\nbut text"
    assert (got[2], got[3], got[4]) == ("", "", "a &am b & c")


def test_site_templates_go_and_articles_stay(spark):
    site = "<div><span>Great site since</span> 1999</div><div class=x1><p>Follow the river</p></div>"
    pages = [page(f"{site}<p>Story {i} of this page</p>{site}", "a.example") for i in range(10)]
    pages += [page(f"{site}<p>Other {i}</p>", f"b{i}.example") for i in range(3)]
    pages += [page("<article><p>Shared licence passage</p><p>Own %d</p></article>" % i, "c.example") for i in range(8)]
    pages += [pages[0]] * 5  # equal pages count once
    got = texts(spark, pages)
    assert all(got[i] == f"Story {i} of this page" for i in range(10))
    assert all("Great site since" in got[10 + i] for i in range(3))
    assert all(got[13 + i] == f"Shared licence passage\nOwn {i}" for i in range(8))
    assert all(got[21 + i] == got[0] for i in range(5))


def test_furniture_of_a_tenth_of_a_large_host_goes(spark):
    furniture = "<div class=x1><p>Follow the river</p></div>"
    pages = [page(f"<p>Story {i} of this page</p>{furniture if i % 10 == 0 else ''}") for i in range(300)]
    pages += [page(f"<p>Tale {i}</p><p>{'A chance repeat' if i < 3 else 'no'} {i if i >= 3 else ''}</p>", "b.example") for i in range(20)]
    got = texts(spark, pages)
    assert all(got[i] == f"Story {i} of this page" for i in range(300))
    assert all(got[300 + i] == f"Tale {i}\nA chance repeat" for i in range(3))


def test_near_copies_of_an_article_keep_shared_lists_and_sections(spark):
    shared = (
        "<ul><li>first<li><div>second</div></ul><ol><li>third</ol><section><h2>Head</h2><p>Same words</p></section>"
        "<div><div><p>Inner</p></div></div><div>Follow us <a>here</a><p>By the way</p><b>now</b></div><div>Loose furniture</div>"
    )
    got = texts(spark, [page(f"<article><p>Own {i}</p>{shared}</article>") for i in range(6)])
    kept = "first\nsecond\nthird\nHead\nSame words\nInner\nBy the way"
    assert all(got[i] == f"Own {i}\n{kept}" for i in range(6))


@pytest.mark.parametrize(
    "body",
    [
        "<div class='content-sidebar-wrap'><main><article><p>%s</article></main></div>",
        "<div id=page class='has-sidebar'><article><p>%s</article></div>",
        "<div class='site nav-open'><article><p>%s</article></div>",
        "<div class='sidebar'><article><p>%s</article></div>",
        "<form id=aspnetForm><div class=header>x</div><article><p>%s</article></form>",
        "<article><div class='market-share'><p>%s</div></article>",
        "<article><div class='side-effects'><p>%s</div></article>",
        "<article><div class='form-of-verbs'><p>%s</div></article>",
        "<article><section class='ad-free'><p>%s</section></article>",
        "<div class='page has-sidebar'><div class='content'><p>%s</div><div class='sidebar'><p>aside</div></div>",
        "<form><h1>%s</h1><div class=menu>menu</div></form>",
        "<div class=main-navigation><a>menu</a></div><p>%s<div class='site-footer'><p>foot</p></div>",
        "<article><p>%s</p><div class='comments'><article><p>first!</article></div></article>",
        "<article><p>%s</p></article><div class='comments'><article><p>first!</article></div>",
    ],
)
def test_names_never_take_the_article_away(body):
    assert html_main.page_text(page(body % "Body text")[1]) == "Body text"


def test_near_copies_without_an_article_element_keep_what_they_share(spark):
    pages = [page(f"<div><h1>Shared head</h1><p>Shared words</p><p>own {i}</p></div>") for i in range(4)]
    menu = "<ul class=x7><li><a>Home</a><li><a>News</a></ul>"
    pages += [page(f"{menu}<p>Tale {i}</p><ul><li>point one<li>point two</ul>", "b.example") for i in range(6)]
    got = texts(spark, pages)
    assert all(got[i] == f"Shared head\nShared words\nown {i}" for i in range(4))
    assert all(got[4 + i] == f"Tale {i}\npoint one\npoint two" for i in range(6))


def test_furniture_with_neutral_names_goes_by_recurrence_alone(spark):
    menu = "<div class=q1><a>Home</a> <a>World</a></div><div class=q2><p>Since 1999</p></div>"
    pages = [page(f"{menu}<article><div class=z9>Read on</div><p>Story {i}</p></article>") for i in range(5)]
    pages += [page(f"{menu}<p>Tale {i}</p>", "b.example") for i in range(5)]
    on, off = texts(spark, pages), texts(spark, pages, least_pages=10**6)
    assert all(on[i] == f"Story {i}" and on[5 + i] == f"Tale {i}" for i in range(5))
    assert all("Read on" in off[i] and "Since 1999" in off[5 + i] for i in range(5))


def test_templates_equal_plain_counts_per_host(spark):
    r, pages = random.Random(7), []
    for i in range(60):
        parts = [f"<div class=c{k}><p>part {k}</p></div>" for k in r.sample(range(9), 4)]
        pages.append((i, f"h{i % 3}", page("".join(parts) + f"<p>own {i}</p>")[1]))
    df = spark.createDataFrame(pages, "page_key long, host string, html string")
    seen = {}
    for i, host, text in pages:
        for h in {h for h, *_ in html_main.candidates(text)[1]}:
            seen.setdefault((host, h), set()).add(i)
    least = max(html_main.TEMPLATE_PAGES, 5)  # 20 pages a host: the binary logarithm is above 4
    want = {}
    for (_, h), where in seen.items():
        for i in where if len(where) >= least else ():
            want.setdefault(i, set()).add(h)
    got = {x.page_key: set(x.templates) for x in html_main.templates(df).collect()}
    assert got == want and want


def test_very_long_page(spark):
    text = "<article>" + "<div class=sidebar-x><p>word & more</p></div>" * 40_000 + "</article>"
    assert html_main.page_text(text).count("\n") == 39_999


def test_random_markup_never_fails():
    r = random.Random(4)
    bits = ["<p>", "</p>", "<div class='a b'>", "</div>", "<article>", "</article>", "<li>", "<td>", "text ", "&amp;", "<", ">", "<!--", "-->", "<script>", "</script>", "<br/>", "\"", "'", "<a href=x>", "</a>", "<title>"]
    for _ in range(500):
        t = "".join(r.choice(bits) for _ in range(30))
        root, found = html_main.candidates(t)
        html_main.main_text(html_main.mains(root))
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert html_main.main_text(html_main.mains(html_main.candidates(deep)[0])) == "x" and html.unescape("&lt;") == "<"


@pytest.mark.parametrize("rows", [[], [(1, "https://a/b", None)]])
def test_no_pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_main.extract(df).count() == len(rows)
