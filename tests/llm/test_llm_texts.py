"""Page texts, line rules, quality scores, secrets and language-model scores on small inputs."""

import base64
import hashlib
import math
import re
import time
import zlib
from collections import Counter

import pytest
from edge_cases import TEXTS, documents, key
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import TaskContext

from refgauge.llm import html_blocks, line_rules, maxent, quality, secrets
from refgauge.llm.queries import QUERIES

MENU = "<ul><li><a href=a>Home of all</a><li><a href=b>News</a></ul>"
PROSE = "The story of the man and the sea is a tale of that which is in all of us. "


def test_blocks_of_an_article():
    page = (
        '<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script>'
        '</head><body><header><h1>Site</h1></header><nav><ul><li><a href="/x">The home of all</a></ul></nav>'
        '<!-- <p>not this</p> --><div class="ad">' + PROSE * 3 + "</div><article><header><h1>A &amp; B</h1></header>"
        "<p><b>Short &eacute;&#233;&#x41;.<br>Next<p>" + PROSE * 3 + "<blockquote>Odd.</blockquote>"
        '<aside>' + PROSE * 3 + '</aside><p>Last&nbsp;one\n\t here.</p><section class="comments"><p>' + PROSE * 3
        + '</section></article><form><p>Send</form><footer>&copy; ' + PROSE * 3 + "</footer></body></html>"
    )
    assert html_blocks.main_text(page) == "\n".join(
        ["A & B", "Short ééA. Next", (PROSE * 3).strip(), "Odd.", "Last one here."]
    )


def test_blocks_without_landmarks_are_told_by_their_words():
    page = (
        '<html lang="en"><body><ul><li><a href=a>Home of all</a><li><a href=b>News</a></ul><h2>A title</h2><p>' + PROSE * 4
        + "<p>Short one.<p>" + PROSE * 3 + "<p>" + "Buy shoes boots socks hats gloves shirts coats belts ties. " * 4
        + "<p>cheap goods</body>"
    )
    assert html_blocks.main_text(page).split("\n") == ["A title", (PROSE * 4).strip(), "Short one.", (PROSE * 3).strip()]


@pytest.mark.parametrize(("inside", "text"), [
    ("Energy <math><mi>E</mi><annotation encoding=tex>\\E</annotation></math> is conserved.", "Energy E is conserved."),
    ("Press <button>Start</button> to begin.", "Press Start to begin."),
    ("One of <select><option>a<option>b</select> two.", "One of two."),
    ("An <object data=x>old plan</object> and a <canvas>chart</canvas>.", "An old plan and a chart."),
])
def test_articles_keep_what_stands_in_their_sentences(inside, text):
    page = f'<html lang="en"><body>{MENU}<article><p>{PROSE * 3}<p>{inside}<p>{PROSE * 2}</article></body></html>'
    assert html_blocks.main_text(page).split("\n") == [(PROSE * 3).strip(), text, (PROSE * 2).strip()]


def test_lists_of_links_stay_in_their_article():
    links = "<ul><li><a href=a>First thing</a><li><a href=b>Second thing</a></ul>"
    page = f'<html lang="en"><body>{links}<article><p>{PROSE * 3}{links}<p>{PROSE * 2}</article>{links}</body></html>'
    assert html_blocks.main_text(page).split("\n") == [(PROSE * 3).strip(), "First thing", "Second thing", (PROSE * 2).strip()]


RUSSIAN = "Город стоит на берегу широкой реки, и жители его издавна строили лодки для торговли с соседями. "
POLISH = "Miasto leży nad szeroką rzeką, a jego mieszkańcy od dawna budowali łodzie do handlu z sąsiadami. "
CHINESE = "这座城市位于一条宽阔的河流旁边，当地居民自古以来就建造船只与邻近地区进行贸易往来。"


@pytest.mark.parametrize("prose", [RUSSIAN, POLISH, CHINESE])
@pytest.mark.parametrize("lang", ["", ' lang="{}"'])
def test_pages_in_languages_without_a_list(prose, lang):
    lang = lang.format({RUSSIAN: "ru", POLISH: "pl", CHINESE: "zh"}[prose])
    page = f"<html{lang}><body>{MENU}<p>{prose * 4}<p>{prose * 3}<footer>{prose * 4}</footer></body></html>"
    assert html_blocks.main_text(page).split("\n") == [(prose * 4).strip(), (prose * 3).strip()]
    assert html_blocks.main_text(f'<html lang="en"><body>{MENU}<p>{RUSSIAN * 4}</body>') == (RUSSIAN * 4).strip()


@pytest.mark.parametrize("opening", ['div class="has-sidebar"', 'div id="page-with-nav"', "form action=x", 'div class="comments-open"'])
def test_wrappers_do_not_hide_the_article(opening):
    body = f'<div class="sidebar"><p>{PROSE * 3}</div>{MENU}<p>{PROSE * 4}<p>{PROSE * 3}<nav><p>{PROSE * 9}</nav>'
    page = f'<html lang="en"><body><{opening}>{body}</{opening.split()[0]}></body></html>'
    assert html_blocks.main_text(page).split("\n") == [(PROSE * 4).strip(), (PROSE * 3).strip()]


def test_boilerplate_beside_the_article_stays_out():
    rest = f'{MENU}<div class="comments"><p>{PROSE * 3}<p>{PROSE * 3}<p>{PROSE * 3}</div><div class="cookie">{PROSE * 3}</div>'
    for article in (f"<article><p>{PROSE * 4}</article>", f"<p>{PROSE * 4}"):
        assert html_blocks.main_text(f'<html lang="en"><body>{article}{rest}</body>') == (PROSE * 4).strip()


@pytest.mark.parametrize(
    "page", ["", "<", "<p", "&", "<!--", "<script>x", "</p></div>", "<a " * 20000, "<b>" * 20000 + "</i>" * 20000,
             '<p a="' * 10000, "<p>x" * 20000, "<" * 30000, "<!" * 20000, "<div hidden>x" * 5000]
)
def test_broken_pages_do_no_harm(page):
    html_blocks.main_text(page)


def test_pages(spark, sf):
    rows = spark.createDataFrame(
        [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<article><p>Hi</article>", "x"), (2, "u", "", "x")],
        "page_id long, url string, html string, HTML2 string",
    )
    assert sorted(map(tuple, html_blocks.extracted(rows).collect()), key=key) == sorted(
        [(1, None, "", 0), (2, "u", "", 0), (2, "u", "", 0), (None, "u", "Hi", 2)], key=key
    )
    assert html_blocks.extracted(rows.limit(0)).collect() == []
    # In the test pages the article element holds the main text, and nothing else does.
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    import html

    for row in QUERIES["op3_html_blocks"](spark, sf).collect():
        article = re.search(r"<article>(.*)</article>", pages[row.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n".join(filter(None, blocks)) and row.n_chars == len(row.text)


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), failed,
    )


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\x0b\x1c\x85\xa0é#|!."), max_size=200))
def test_counts_of_lines_and_words(text):
    assert tuple(line_rules.judge(text))[:6] == base_counts(text)


def test_line_rules():
    prose = " ".join(f"word{k} of{k} the{k} tale{k}." for k in range(20))
    assert line_rules.judge(prose).kept
    for bad in ("a | b | c | d", "Home Login Contact", "We use: accept all cookies", "BUY!! NOW!! IT!!", "x %%% y ***"):
        found = line_rules.judge(f"{prose}\n{bad}")
        assert found.kept and found.cleaned == prose, bad
    assert line_rules.judge(f"{prose}\n{prose}").cleaned == prose
    junk = "\n".join(f"a{k} | b{k} | c{k} | d{k} | e{k}" for k in range(60))
    found = line_rules.judge(f"A line that stays.\n{junk}")
    assert not found.base_failed and not found.kept and found.cleaned == "A line that stays."


def test_line_rules_of_edge_cases(spark, sf):
    rows = line_rules.judged(documents(spark)).collect()
    want = [(i, *line_rules.judge(t or "")) for i, t in TEXTS]
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert line_rules.judged(documents(spark, [])).collect() == []
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op4_line_rules"](spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        assert tuple(r)[1:7] == base_counts(docs[r.doc_id])
        assert not (r.base_failed and r.kept)


def plain_entries(text, buckets):
    """Every table entry of a text, gram by gram."""
    mask, found = (1 << 64) - 1, []
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", text.encode()) if w]

    def place(number):
        return (number & mask) * quality.SPREAD[0] % (mask + 1)

    for w in words:
        found.append(zlib.crc32(w) % buckets)
        own = b"<" + w + b">"
        for n in (2, 3, 4):
            for k in range(len(own) - n + 1):
                number = int.from_bytes(own[k : k + n], "big") * quality.SPREAD[n - 2] & mask
                found.append((number >> 33) % buckets)
    letters = [w.decode()[0].encode() for w in words]
    for kind, (tokens, lengths) in enumerate(((words, quality.WORD_GRAMS), (letters, quality.INITIAL_GRAMS))):
        for n in lengths:
            for k in range(len(tokens) - n + 1):
                number = zlib.crc32(tokens[k])
                for t in tokens[k + 1 : k + n]:
                    number = place(number ^ number >> 31) + zlib.crc32(t) & mask
                found.append((place(number + kind) >> 33) % buckets)
    return Counter(found)


SMALL = ["", "a", "one two", "one two three\nfour five", "ñu ñu ñu 漢字 😀 x", "the the the the end", "a b c d e f g a b c"]


def test_quality_features_and_scores_are_the_plain_ones():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    model = quality.Model(rng.normal(size=512).astype(np.float32), 0.3)
    want = []
    for text in SMALL:
        plain = plain_entries(text, 512)
        assert {k: int(n) for k, n in enumerate(quality.bag(text, 512)) if n} == plain
        mean = sum(float(model.value[k]) * n for k, n in plain.items()) / (sum(plain.values()) + quality.PRIOR)
        want.append(1 / (1 + math.exp(-mean - model.bias)))
    for limit in (3, 1000):
        scorer = quality.Scorer(model, limit)
        for at in (0, 3, 0):
            assert scorer.scores(pa.array(SMALL[at:])) == pytest.approx(want[at:], abs=1e-6)


def test_quality_training_tells_labels_apart():
    """Labels that words tell apart are learned from mini-batches."""
    import numpy as np
    from types import SimpleNamespace

    rows = []
    for k, text in enumerate(["good words here", "bad bad bad", "more good words", "bad again bad"] * 30):
        total = quality.bag(text, 256)
        used = np.flatnonzero(total)
        rows.append(SimpleNamespace(label=1 - k % 2, entries=used.astype("<u2").tobytes(), counts=total[used].astype("<f4").tobytes()))
    model = quality.train(rows, 256, epochs=40)
    score = lambda text: 1 / (1 + math.exp(-float((model.value * (b := quality.bag(text, 256))).sum()) / (b.sum() + quality.PRIOR) - model.bias))
    assert score("good words here") > 0.8 > 0.2 > score("bad bad bad")
    with pytest.raises(ValueError):
        quality.bags(None, 1 << 17)


def test_quality_learns(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op7_subword_quality"](spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    told = [(labels[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in labels]
    good = [p for label, p, _ in told if label]
    assert sum(good) >= 0.95 * len(good)
    ranks = [(a > b) + (a == b) / 2 for x, _, a in told if x for y, _, b in told if not y]
    assert sum(ranks) / len(ranks) > 0.9


def test_quality_of_edge_cases(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(9, 1, 0), (7, 0, 0), (7, 0, 0), (11, None, 0), (None, 1, None), (999, 1, 0), (14, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    first, second = (
        sorted(map(tuple, quality.scored(docs, quality.learned(docs, labels)).collect()), key=key) for _ in range(2)
    )
    assert first == second and len(first) == len(TEXTS)
    empty = quality.scored(docs, quality.learned(docs, labels.limit(0))).collect()
    assert {r.score for r in empty} == {0.5}
    model = quality.learned(documents(spark, []), labels)
    assert quality.scored(documents(spark, []), model).collect() == []
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS)


def der(n):
    return b"\x30\x82" + n.to_bytes(2, "big") + bytes(k * 7 % 256 for k in range(n))


def armored(kind, data, newline="\n", told=(), sums=None):
    body = base64.b64encode(data).decode()
    lines = [*told, *([""] if told else []), *(body[k : k + 64] for k in range(0, len(body), 64)), *([sums] if sums else [])]
    return newline.join([f"-----BEGIN {kind}-----", *lines, f"-----END {kind}-----"])


ENCRYPTED = ("Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B2C")
KEYS = [
    armored("RSA PRIVATE KEY", der(600)), armored("PRIVATE KEY", der(300), "\\n"), armored("EC PRIVATE KEY", b"\x30\x77" + b"k" * 0x77),
    armored("RSA PRIVATE KEY", b"c" * 608, told=ENCRYPTED), armored("RSA PRIVATE KEY", b"c" * 608, "\\r\\n", ENCRYPTED),
    armored("OPENSSH PRIVATE KEY", b"openssh-key-v1\0" + b"k" * 99),
    armored("PGP PRIVATE KEY BLOCK", b"123456789", told=("Version: GnuPG v2 (GNU/Linux)",), sums="=Ic8C"),
    "-----BEGIN PRIVATE KEY----- " + base64.b64encode(der(40)).decode() + " -----END PRIVATE KEY-----",
]


@pytest.mark.parametrize("key", KEYS)
def test_private_keys_in_other_forms(key):
    text = f"é key: {key} end"
    assert secrets.spans_of(text) == [("private_key", 7, 7 + len(key))]


@pytest.mark.parametrize("key", [
    armored("PRIVATE KEY", der(300)[:-1]), armored("PRIVATE KEY", b"just some text"), armored("RSA PRIVATE KEY", b"c" * 607, told=ENCRYPTED),
    armored("PGP PRIVATE KEY BLOCK", b"123456780", sums="=Ic8C"), "-----BEGIN PRIVATE KEY-----\nnot=base64\n-----END PRIVATE KEY-----",
])
def test_what_only_looks_like_a_private_key(key):
    assert secrets.spans_of(key) == []


@pytest.mark.parametrize("text", [
    "eyJ" * 100000, base64.b64encode(b'[' + b'{"a":1},' * 125000 + b"]").decode(), "/eyJhb" * 50000, "eyJ." * 100000, "eyJa.eyJb-" * 50000,
    "-----BEGIN PRIVATE KEY-----" * 20000, ("-----BEGIN PRIVATE KEY-----\n" + "abcd" * 50) * 5000, "-----BEGIN PRIVATE KEY-----\n" + "a: b\n" * 100000,
    "card " * 50000 + "4 " * 100000, "password=" * 50000, "token:" + "a" * 500000,
])
def test_long_runs_take_no_time(text):
    start = time.process_time()
    secrets.spans_of(text)
    assert time.process_time() - start < 2


@pytest.mark.parametrize(("text", "kind", "number"), [
    ("my card, issued in May, is 4111 1111 1111 1111 12/27", "card", "4111 1111 1111 1111"),
    ("Card ending 1111 (4111-1111-1111-1111)", "card", "4111-1111-1111-1111"),
    ("the IBAN of the club is DE89 3704 0044 0532 0130 00 BIC", "iban", "DE89 3704 0044 0532 0130 00"),
    ("IBAN for gifts is BE68 5390 0754 7034 PLEASE", "iban", "BE68 5390 0754 7034"),
    ("my card, issued in May, is 4111 1111 1111 1112", "card", None),
    ("card " + "x" * 70 + " 4111 1111 1111 1111", "card", None),
])
def test_numbers_some_words_after_their_keyword(text, kind, number):
    want = [(kind, text.index(number), text.index(number) + len(number))] if number else []
    assert secrets.spans_of(text) == want


def base_spans(text):
    found = []
    for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A
    ):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


PARTS = st.sampled_from(
    ["password", "PassWd", "token", "api_key", "apikey", "secret", "AKIA", "ABCDEFGHIJKLMNOP", "=", ": ", '"', " ", "é", "😀",
     "0123456789abcdef", "0123456789abcdef" * 2, "abcdefgh1", "\n", "x", "ſecret", "toKen"]
)


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_spans(text):
    found = secrets.spans_of(text)
    assert [span for span in found if span[0] in ("assign", "access", "hex")] == base_spans(text)


def test_added_kinds_need_their_checksums():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    value, check = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        check = secrets.DIGITS[digit] + check
    good = f"ghp_{body}{check.rjust(6, '0')}"
    assert [s[0] for s in secrets.spans_of(f"see {good} there")] == ["code_host"]
    assert secrets.spans_of(f"see {good[:-1]}{'0' if good[-1] != '0' else '1'} there") == []
    assert [s[0] for s in secrets.spans_of("card 4111 1111 1111 1111.")] == ["card"]
    assert secrets.spans_of("card 4111 1111 1111 1112.") == []
    assert [s[0] for s in secrets.spans_of("IBAN DE89 3704 0044 0532 0130 00")] == ["iban"]
    assert secrets.spans_of("IBAN DE88 3704 0044 0532 0130 00") == []
    assert [s[0] for s in secrets.spans_of("eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc")] == ["web_token"]
    assert secrets.masked("a password=12345678 z", secrets.spans_of("a password=12345678 z")) == "a [assign] z"


def test_secrets_of_edge_cases(spark):
    rows = secrets.scan(documents(spark)).collect()
    want = []
    for i, text in TEXTS:
        spans = base_spans(text or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == kind for s in spans) for kind in ("assign", "access", "hex")]
        want.append((i, *counts, hashlib.sha256(told.encode()).hexdigest(), told))
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert secrets.scan(documents(spark, [])).collect() == []
    docs = documents(spark)
    masked = secrets.without_secrets(docs)
    assert masked.columns == docs.columns
    assert sorted((tuple(r)[:2] for r in masked.collect()), key=key) == sorted(
        ((i, t if t is None else secrets.masked(t, secrets.spans_of(t))) for i, t in TEXTS), key=key
    )


def test_secrets_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op10_secret_scan"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(docs[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()


def check_scores(rows, texts):
    def tokens(text):
        return (text or "").encode().lower().split() + [b"\n"]

    def out(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    counts = Counter(w for i, t in texts if not out(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, text in texts:
        words = tokens(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        want.append((i, out(i), len(words), sum(counts[w] > 0 for w in words), total, round(base, 6)))
    found = [(*tuple(r)[:5], round(r.base_score, 6)) for r in rows]
    assert sorted(found, key=key) == sorted(want, key=key)


def test_scores_of_edge_cases(spark):
    rows = maxent.learned_and_scored(documents(spark)).collect()
    check_scores(rows, TEXTS)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert maxent.learned_and_scored(documents(spark, [])).collect() == []


def test_scores_when_all_is_held_out(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:4]
    texts = [(i, "some words here") for i in held]
    rows = maxent.learned_and_scored(documents(spark, texts)).collect()
    check_scores(rows, texts)
    assert all(math.isfinite(r.score) for r in rows)


def test_model_beats_the_base_on_held_out_texts(spark, sf):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op9_maxent_scores"](spark, sf).collect()
    check_scores(rows, texts)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_classes_are_distributions():
    import numpy as np

    weights = np.random.default_rng(1).normal(size=(maxent.FEATURES, maxent.CLASSES))
    sums = np.exp(maxent.log_classes(weights, np.arange(0, maxent.HISTORY, 997))).sum(1)
    assert np.allclose(sums, 1)


def test_features_are_counted_beyond_24_bits():
    import numpy as np

    none, n = np.empty(0, np.int64), 1000
    history = np.zeros((maxent.HISTORY, maxent.CLASSES), np.float32)
    model = maxent.Model(none, none, history, maxent.words_of(none, none), none, np.zeros(maxent.FORMS))
    weights, seen, expected = (tuple(np.zeros((1024, k), np.float32) for k in (maxent.CLASSES, maxent.SLOTS)) for _ in range(3))
    seen[0][:] = 1 << 24  # here a float32 and one is itself
    ends = np.arange(1, n + 1)
    maxent.count_features(model, weights, np.full(n, maxent.END_CODE, np.int32), ends, seen, expected)
    added = seen[0].astype(np.int64) - (1 << 24)
    assert added.sum() == maxent.WORD_FEATURES * n == added[:, maxent.END_CLASS].sum()
    assert np.isclose(expected[0].sum(), maxent.WORD_FEATURES * n)


def test_the_driver_does_not_train(spark, sf, monkeypatch):
    own = quality.train

    def in_tasks(*args):
        assert TaskContext.get() is not None
        return own(*args)

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    monkeypatch.setattr(quality, "train", in_tasks)
    assert abs(quality.learned(docs, labels).value).sum() > 0


def test_words_depend_on_the_words_before(spark):
    import random

    deal = random.Random(3)
    pairs = [(f"left{i}x", f"right{i}y") for i in range(300)]
    swapped = [(a, pairs[(i + 1) % 300][1]) for i, (a, _) in enumerate(pairs)]
    held = [i for i in range(100_000) if zlib.crc32(str(i).encode()) % 7 == 2]
    taught = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 != 2]
    texts = [(i, " ".join(w for pair in deal.choices(pairs, k=60) for w in pair)) for i in taught]
    texts += [(held[k], " ".join(pair)) for k, pair in enumerate(pairs + swapped)]
    scores = {r.doc_id: r.score for r in maxent.learned_and_scored(documents(spark, texts)).collect()}
    right, wrong = (sum(scores[i] for i in ids) / 300 for ids in (held[:300], held[300:600]))
    assert right - wrong > 1.5


def test_scores_are_products_of_softmaxes_over_word_features():
    import numpy as np

    random = np.random.default_rng(2)
    n, words = 700, 600  # of the dictionary, of the vocabulary
    rank = (-1 - random.integers(0, maxent.FORMS, n)).astype(np.int32)
    rank[random.permutation(n)[:words]] = np.arange(words)
    own = np.where(np.arange(words) < 150, 5, random.integers(0, maxent.PLAIN, words))
    history = random.normal(size=(maxent.HISTORY, maxent.CLASSES)).astype(np.float32)
    choice = maxent.words_of(own, random.integers(1, 50, words))
    log_form = random.random(maxent.FORMS)
    model = maxent.Model(rank, own, history, choice, random.random(n), log_form)
    weights = [random.normal(size=(1024, k)).astype(np.float32) for k in (maxent.CLASSES, maxent.SLOTS)]
    texts = [random.integers(-8, n, size) for size in (0, 1, 2, 5, 9000)]
    texts = [np.append(t, maxent.END_CODE).astype("<i4") for t in texts]
    found = maxent.text_scores(model, weights, np.concatenate(texts), np.cumsum([len(t) for t in texts]))

    def share(start, features, node, kind, chosen):
        logits = start.astype(float)
        for row in maxent.rows_of(features, node, 1024):
            logits = logits + weights[kind][row]
        return logits[chosen] - np.log(np.exp(logits).sum())

    for text, got in zip(texts, found):
        text = text[:400] if len(text) > 1000 else text
        kinds = [
            maxent.END_CLASS if t == maxent.END_CODE else maxent.PLAIN - t if t < 0
            else own[rank[t]] if rank[t] >= 0 else maxent.PLAIN - rank[t]
            for t in text.tolist()
        ]
        features = maxent.word_features(text, np.array([len(text)]))
        total, seen = 0.0, [maxent.START] * 3
        for k, (t, kind) in enumerate(zip(text.tolist(), kinds)):
            cell = (seen[-1] * (maxent.CLASSES + 1) + seen[-2]) * (maxent.CLASSES + 1) + seen[-3]
            seen.append(kind)
            total += share(history[cell], features[:, k], 0, 0, kind) / np.log(10)
            if t >= 0 and rank[t] >= 0:
                r = rank[t]
                if (own == own[r]).sum() > maxent.SLOTS:
                    total += share(choice.start[own[r]], features[:, k], own[r] + 1, 1, choice.group[r]) / np.log(10)
                node = choice.node[r]
                total += share(choice.start[node], features[:, k], node + 1, 1, choice.slot[r]) / np.log(10)
            elif t != maxent.END_CODE:
                total += (model.log_times[t] if t >= 0 else 0.0) - log_form[-1 - (rank[t] if t >= 0 else t)]
        if len(text) < 400:
            assert math.isclose(got, total, rel_tol=1e-4)
        else:
            short = maxent.text_scores(model, weights, text, np.array([len(text)]))
            assert math.isclose(short[0], total, rel_tol=1e-4)
