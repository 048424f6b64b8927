"""Language, toxicity, secrets and token counts against plain loops and edge cases."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import pytest

from inkwell.llm import language, secrets, tokens, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def text_in(r, words, n=40):
    return " ".join(r.choice(words) for _ in range(n)).capitalize() + "."


WORDS = {"en": "the of and that with there house water".split(), "de": "der und nicht schön über haus wasser".split(), "el": "και το νερό σπίτι είναι".split()}


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(3)
    rows = [(i, text_in(r, WORDS[lang]), lang, "s", 1) for i, lang in enumerate(list(WORDS) * 30)]
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "12 :: 34 !!", None, None, 0), (None, text_in(r, WORDS["de"]), "de", "s", 1)]
    rows += [(903, text_in(r, WORDS["en"]) * 500, "en", "s", 1)] + [rows[0]] * 2
    return rows


def test_language_is_learnt_and_predicted(spark, corpus):
    df = spark.createDataFrame(corpus, DOCS).selectExpr("*", "'x' as score", "'y' as lang_pred")
    rows = language.language_query(df).collect()
    assert len(rows) == len(corpus)
    found = {r.doc_id: r for r in rows}
    for i, _, lang, *_ in corpus[:90]:
        assert found[i].lang_pred == lang and 0 <= found[i].score <= 1
        assert found[i].held_out == (crc(i, 4) == 2)
    assert [found[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert found[None].lang_pred == "de" and not found[None].held_out
    assert found[903].lang_pred == "en"


def test_held_out_rows_teach_nothing(spark, corpus):
    rows = [x for x in corpus if x[0] is not None and crc(x[0], 4) == 2]
    found = language.language_query(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.lang_pred for r in found} == {"und"}
    assert language.language_query(spark.createDataFrame([], DOCS)).collect() == []


def test_ngram_counts_match_a_loop_in_any_block_size(monkeypatch):
    def plain(text):
        s = " " + re.sub(r"[^a-zäö]+", " ", text.lower()) + " "
        s = re.sub(" +", " ", s)
        grams = Counter()
        for n in (1, 2, 3):
            for i in range(len(s) - n + 1):
                g = s[i : i + n]
                if g != " " and (n < 3 or g[1] != " "):
                    grams[g] += 1
        return {sum(ord(c) << 21 * (len(g) - 1 - j) for j, c in enumerate(g)): n for g, n in grams.items()}

    text = "Hello, wörld -- the end of the wörld.  x"
    for block in (1 << 20, 5, 1):
        monkeypatch.setattr(language, "BLOCK", block)
        codes, counts = language.ngram_counts(text)
        assert dict(zip(codes.tolist(), counts.tolist())) == plain(text)


def test_out_of_place_distance():
    import numpy as np

    p = language.Profiles(["a", "b"], np.array([ord("x"), ord("y")]), np.array([[0, 1], [1, 0]]), 300)
    own = language.top_codes(*language.ngram_counts("xx y"), 300)
    want = [sum(abs(list(o).index(g) - list(own).index(g)) if g in o else 300 for g in own.tolist()) for o in ([ord("x"), ord("y")], [ord("y"), ord("x")])]
    name, score = p.predict("xx y")
    assert name == "ab"[want.index(min(want))] and score == pytest.approx(1 - min(want) / (300 * len(own)))


def test_fold_reads_lookalikes_and_signs():
    for x in ("idiot", "1d10t", "IDI0T!", "іdіоt", "ïdìöt", "id!ot", "idio7"):
        assert toxicity.fold(x) == " idiot "
    assert toxicity.fold("end$$$ 2024 a1b") == " end aib "
    assert toxicity.fold("") == "  " or toxicity.fold("").strip() == ""


def test_every_letter_may_be_a_sign():
    signs = {v: [k for k, x in toxicity.SIGNS.items() if x == v] for v in toxicity.SIGNS.values()}
    words = ["idiot", "worthless", "shit", "ass", "scum", "lostraei"]
    m = toxicity.Lexicon({f" {w} ": 2.0 for w in words[:5]} | {" lostra": 2.0}, ("class clown",)).matcher()
    for w in words:
        want = toxicity.weigh(w, m)
        assert want[0] > 0
        for pick in range(3):
            full = "".join(signs[c][pick % len(signs[c])] if c in signs else c for c in w)
            full = full if any(map(str.isalpha, full)) else w[0] + full[1:]
            for t in (full, full.upper(), full + "!!!", "$$$" + full, full + "0" * 50, full[:2] + "\u200b" + full[2:], full[:2] + "\u0335\u00ad" + full[2:]):
                assert toxicity.weigh(t, m) == want, t
            assert toxicity.weigh(f"{full}!{w}|x", m)[0] > want[0]  # two words
    for t in ("2024 55 100", "class!", "10th", "b4nd", "x" + "0" * 20, "cl4ss cl0wn!"):
        assert toxicity.weigh(t, m) == (0.0, 0.0), t
    assert toxicity.fold("w0rthl355 1d107 sh17 a55") == " worthless idiot shit ass "
    assert toxicity.words_of("a$$ end!") == {"a", "ass", "end", "endi"}


def test_weights_use_stems_exceptions_and_length():
    lexicon = toxicity.Lexicon({" trash ": 2.0, " lowei": 3.0, " loweix ": 4.0}, ("trash can",))
    m = lexicon.matcher()
    assert toxicity.weigh("the trash can", m) == (0.0, 0.0)
    one = toxicity.weigh("such trash here", m)
    assert one[0] > 0 and one[1] > toxicity.weigh("such trash here " + "word " * 50, m)[1]
    assert toxicity.weigh("loweix", m)[0] == pytest.approx(toxicity.weigh("loweix", toxicity.Lexicon({" loweix ": 4.0}).matcher())[0])
    assert toxicity.weigh("slowei", m) == (0.0, 0.0)


def test_logistic_fit_settles_on_separable_cells():
    import numpy as np

    # the cells of a table whose clean rows share one weak word with the toxic ones
    x = np.array([[0, 0], [1.5, 2.0], [2.25, 2.5], [2.75, 3.25], [3.0, 3.5]])
    fit = toxicity._logistic(x, np.array([0, 0, 0, 1, 1.0]), np.array([100, 20, 1, 25, 8.0]))
    z = fit[0] + x @ np.array(fit[1:])
    assert (z[:3] < 0).all() and (z[3:] > 0).all()


def test_toxicity_is_learnt_from_the_training_part(spark):
    r = random.Random(5)
    bad = ["idiot", "moron"] + [f"lostra{x}" for x in ("un", "ei", "ich", "ade", "ung", "wo", "ts", "ku")]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        t = text_in(r, WORDS["en"], 30) + (" " + " ".join(r.sample(bad, 3)) if toxic else "")
        rows.append((i, t, "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, "You M0R0N", None, None, 1), (1001, "such a lostrazzz", None, None, 1), (1002, None, None, None, 0), (1003, "", None, None, 0), (None, "fine water", None, None, 0)]
    labels += [(1000, 1, None), (None, 1, 1), (5, 1, 0), (7, 1, 1), (7, 1, 0)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as predicted", "2 as score", "3 as toxic")
    out = toxicity.toxicity_query(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {x.doc_id: x for x in out.collect()}
    assert len(found) == len(rows)
    for i in range(400):
        assert found[i].predicted == int(i % 4 == 0) and found[i].held_out == (crc(i, 5) == 0)
    assert found[1000].predicted == 1 and found[1001].predicted == 1
    assert not any(found[i].predicted for i in (1002, 1003, None))
    kept = toxicity.reject_toxic(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.collect()} == {i for i, x in found.items() if not x.predicted}


def labelled_texts(n=600):
    """Toxic rows hold a bad word; clean ones hold "clown fish" often, and a stem's words are spread."""
    r = random.Random(11)
    bad = ["idiot", "moron", "clown", *(f"lostra{x}" for x in ("un", "ei", "ich", "ade", "ung", "wo", "ts", "ku"))]
    rows = []
    for i in range(n):
        toxic = i % 5 == 0
        words = text_in(r, WORDS["en"], 20).split()
        words[3:3] = r.sample(bad, 3) if toxic else ["clown", "fish"] if i % 7 == 0 else []
        rows.append((" ".join(words), int(toxic)))
    return [*rows, ("one single wordonce idiot", 1), (None, 0), ("", 1), ("x", None)]


def test_entries_and_phrases_by_loop(spark):
    rows = labelled_texts()
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"), exceptions=())
    known = [(t or "", y) for t, y in rows if y is not None]
    toxic, clean = sum(y for _, y in known), sum(1 - y for _, y in known)
    base = toxic / len(known)

    def bound(k, n, side):
        z = toxicity.CONFIDENCE
        mid, width = k / n + z * z / (2 * n), z * math.sqrt(k / n * (1 - k / n) / n + z * z / (4 * n * n))
        share = min(max((mid + side * width) / (1 + z * z / n), 1e-9), 1 - 1e-9)
        return math.log(share / (1 - share)) - math.log(base / (1 - base))

    counts = {}
    for t, y in known:
        for w in toxicity.words_of(t):
            counts.setdefault(w, [0, 0])[y] += 1
    stems = {}
    for w, (c, k) in counts.items():
        for n in range(toxicity.STEMS[0], min(toxicity.STEMS[1], len(w) - 1) + 1):
            x = stems.setdefault(w[:n], [0, 0, 0, 0])
            x[0], x[1], x[2], x[3] = x[0] + c, x[1] + k, x[2] + (k > 0), max(x[3], k)
    stems = {w: (k, bound(k - m, c + k - m, -1)) for w, (c, k, kinds, m) in stems.items() if kinds >= 4 and m <= 0.5 * k}
    stems = {w: x for w, x in stems.items() if x[1] >= toxicity.MIN_LOG_ODDS}
    kept = {w for w, (k, _) in stems.items() if not any(len(v) == len(w) + 1 and v.startswith(w) and x[0] >= 0.9 * k for v, x in stems.items())}
    kept = {w for w in kept if not any(v != w and w.startswith(v) for v in kept)}
    want = {f" {w}": stems[w][1] for w in kept}
    for w, (c, k) in counts.items():
        if k > 1 and not any(w.startswith(v) for v in kept) and bound(k - 1, c + k - 1, -1) >= toxicity.MIN_LOG_ODDS:
            want[f" {w} "] = bound(k - 1, c + k - 1, -1)
    assert {" idiot ", " moron "} < want.keys() and any(w.startswith(" lostra") for w in want)
    assert " wordonce " not in want
    assert {p: w for p, w in lexicon.terms.items() if w is not None} == pytest.approx(want)
    phrases = {p for p, w in lexicon.terms.items() if w is None}
    if " clown " in want:
        assert " clown fish " in phrases
    assert not any("idiot" in p or "moron" in p for p in phrases)


def test_blocks_of_a_large_lexicon_score_alike(spark):
    rows = spark.createDataFrame(labelled_texts(), "text string, toxic int")
    whole = toxicity.learn_lexicon(rows)
    parts = toxicity.learn_lexicon(rows, block_bytes=8)
    assert len(parts.more) >= 2
    merged = dict(parts.terms)
    for more in parts.more:
        merged |= more
    assert merged == pytest.approx(whole.terms) if None not in whole.terms.values() else merged.keys() == whole.terms.keys()
    assert parts.fit == pytest.approx(whole.fit)
    texts = [(i, t, 5) for i, t in enumerate(["You M0R0N idiot", "a clown fish", "l0stra8un!idi0t lostraei", None, "", "id10t" * 50])]
    docs = spark.createDataFrame(texts, "id int, body string, hits int").selectExpr("*", "1 as score")
    a, b = (toxicity.score_texts(docs, x, "body") for x in (whole, parts))
    assert a.columns == b.columns == [*docs.columns, "_score"]
    assert [r[-1] for r in b.orderBy("id").collect()] == pytest.approx([r[-1] for r in a.orderBy("id").collect()])


def test_long_texts_take_linear_time():
    m = toxicity.Lexicon({" trash ": 2.0, " idiot ": 3.0}, ("trash can",)).matcher()
    unit = "trash can idiot "
    began = time.perf_counter()
    total, share = toxicity.weigh(unit * (10_000_000 // len(unit)), m)
    assert time.perf_counter() - began < 15
    assert total == pytest.approx(math.log1p(3.0 * (10_000_000 // len(unit))))
    assert share == pytest.approx(math.log1p(100.0))


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [tuple(r)[3] for r in toxicity.toxicity_query(docs, none).collect()] == [0]
    assert toxicity.toxicity_query(docs.limit(0), none).collect() == []


SAMPLES = [
    'password=abcdef1 token: "xyz" API_KEY = \'0123456789\'', "secret=token=abcdef", "password=token: abcdefgh", "AKIA" + "A" * 16 + " AKIAB", "AKIAAKIA" + "B" * 13,
    "0123456789abcdef01234567 f0 " + "a" * 23 + " " + "b" * 30 + "g", "paſſword=abcdefgh", "", "no secrets here: at all = none", "Token=short tokens=longer1",
]


def base_by_loop(text):
    found = [("assign", m.start(), m.end()) for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_base_spans_match_the_plain_patterns():
    r = random.Random(1)
    parts = ["password", "=", ": ", '"', "token", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, " ", "é", "\n", "abc", "api_key", "x" * 7]
    for text in SAMPLES + ["".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(2000)]:
        assert secrets.base_spans(text) == base_by_loop(text)


def test_names_literals_and_constants():
    named = lambda t: [t[a:b] for _, a, b in secrets.named_spans(t)]
    assert named('db.password = "hunter2!"') == ["hunter2!"]
    assert named('k = "s3cr3t-Value"\nclient_secret = k\n') == ["s3cr3t-Value"]
    assert named('k = "s3cr3t-Value"\nk = "other"\nclient_secret = k\n') == []
    assert named('{"accessToken": "aZ9$kk12", "name": "longer-name"}') == ["aZ9$kk12"]
    assert named("authToken := 'abc' + 'Def456x'") == ["Def456x"]
    assert named("const apiKey: string = 'Zz12345678'") == ["Zz12345678"]
    assert named("password: changeme\npassword = ${PASSWORD}\npassword_length = 123456\ntoken_type: bearer1") == []
    assert named("He said: nothing of note = here") == []


def test_phrases_and_every_listed_name():
    named = lambda t: [t[a:b] for _, a, b in secrets.named_spans(t)]
    phrase = 'password = "correct horse battery staple"'
    assert named(phrase) == ["correct horse battery staple"]
    assert secrets.redact(phrase, secrets.secret_spans(phrase)) == 'password = "[SECRET]"'
    assert named('password = "your password here"\nsession = "the first of May"') == []
    assert named('DB_PASS="Xk39fLq2"') == ["Xk39fLq2"]
    for name in secrets.SENSITIVE:
        assert named(f'{name} = "Xk39fLq2"') == ["Xk39fLq2"]
        assert named(f'{name} = "Ab12Ab12"') == ["Ab12Ab12"]
    assert named('key: "username"\naccess = "internal"\nsession_id = "Xk39fLq2"\nname = "Xk39fLq2"') == []


SECRET = "Xk39fLq2Zq81"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("password = user_input", []), ("password = getpass()", []), ('password = os.environ["PASSWORD_X1"]', []), ("f(password=user_input, x=1)", []),
        (f"password = {SECRET}\n", [SECRET]), ("DB_PASSWORD=hunter2secret", ["hunter2secret"]), ("a:\n  password: hunter2secret\n", ["hunter2secret"]),
        (f'$this->k = "{SECRET}"; password = $this->k;', [SECRET]), (f'A::k = "{SECRET}"; token = B::k\n', [SECRET]),
        (f"x['pw'] = '{SECRET}'\npassword = x['pw']\n", [SECRET]), (f'k = "{SECRET}"\nk = other\ntoken = k\n', []),
        ('DB_PASS="correct horse battery staple"', ["correct horse battery staple"]), ('key = "press any key now"', []),
        (f'auth = """{SECRET}"""', [SECRET]), (f"auth = '''{SECRET}'''", [SECRET]), (f"auth = `{SECRET}`", [SECRET]), (f"password: str = '{SECRET}'", [SECRET]),
        ('token = "Xk39fABC" + \\\n  "Lq2Zq81xx"', ["Xk39fABC", "Lq2Zq81xx"]), ('secret = ("Xk39fABC"\n   "Lq2Zq81xx")', ["Xk39fABC", "Lq2Zq81xx"]),
        ("a:\n  private_key: |\n    MIIabc12\n\n    Zk39fLq2\n  b: c\n", ["MIIabc12\n\n    Zk39fLq2"]), ("private_key: |\nb: c\n", []),
        ("token = ''", []), ('token = """', []), ("token = `", []),
    ],
)
def test_literals_and_references(text, want):
    assert [text[a:b] for _, a, b in sorted(secrets.named_spans(text), key=lambda s: s[1])] == want


def test_generated_code_gives_the_planted_literals():
    """Programs of assignments and references against a plain interpreter of the same statements."""
    forms = ['{0} = "{1}"\n', "{0} = '{1}';\n", '"{0}": "{1}",\n', "self.{0} = `{1}`\n", "export {0}={1}\n", 'P::{0} := "{1}"\n', '{0} = """{1}"""\n']
    for seed in range(200):
        r = random.Random(seed)
        plain, secret, text, held, want = ["alpha", "beta", "gamma"], ["db_password", "authToken", "API_SECRET"], "", {}, set()
        for _ in range(12):
            name = r.choice(plain + secret)
            if r.random() < 0.6:
                value = "".join(r.choices("abcdefgh", k=4) + r.choices("ABCDEFGH", k=4) + r.choices("23456789", k=5))
                part = r.choice(forms).format(name, value)
                held[name] = {(len(text) + part.index(value), len(text) + part.index(value) + len(value))}
                text += part
            else:
                other = r.choice(plain + secret)
                text += r.choice(["{0} = {1}\n", "this->{0} = Q::{1};\n", "{0} = self.{1}\n"]).format(name, other)
                held[name] = held.get(other, set())
            if name in secret:
                want |= held[name]
        assert {(a, b) for _, a, b in secrets.named_spans(text)} == want, text


@pytest.mark.parametrize("part", ["a: x", 'a = "b"', "a: ", 'a = """', "a = `", "a:|\n", "a-", 'a = "b" +', "a: x, "])
def test_lexer_is_linear(part):
    def seconds(n):
        start = time.perf_counter()
        secrets.named_spans(part + " " * n)
        secrets.named_spans(part * (n // len(part)))
        return time.perf_counter() - start

    assert seconds(400_000) < 0.2 + 10 * seconds(100_000)


def test_secret_query_and_redaction(spark):
    rows = [(i, t, None, None, len(t)) for i, t in enumerate(SAMPLES)] + [(None, None, None, None, None), (50, 'key_password = "tr0ub4dor&3"', None, None, 3), (50, 'key_password = "tr0ub4dor&3"', None, None, 3)]
    rows.append((51, "word " * 200_000 + "password=abcdef1", None, None, 0))
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as spans", "2 as n_hex")
    found = secrets.secrets_query(docs).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for x in found:
        base = base_by_loop(texts[x.doc_id])
        assert x.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        n = Counter(k for k, _, _ in base)
        assert (x.n_assign, x.n_access, x.n_hex) == (n["assign"], n["access"], n["hex"])
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(x.spans.split(","))
    out = secrets.redact_secrets(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    for x in out.collect():
        assert x.text is None or not base_by_loop(x.text)
    assert {x.text for x in out.where("doc_id = 50").collect()} == {'key_password = "[SECRET]"'}
    assert out.where("doc_id = 51").first().n_chars == len("word " * 200_000 + "password=[SECRET]")
    assert secrets.secrets_query(docs.limit(0)).collect() == []
    assert [s.kind for s in secrets.find_secrets(docs, ["doc_id"]).where("doc_id = 50").first().secrets] == ["assign", "named"]


@pytest.fixture(scope="module")
def tokenizer():
    sentencepiece = pytest.importorskip("sentencepiece")
    pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=tokens.DEFAULT_MODEL)
    t = Tokenizer(models.Unigram([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


def test_counts_equal_the_tokenizer(spark, tokenizer):
    r = random.Random(2)
    texts = ["", " ", "  a", "\n", " \nx", "x▁▁y", "日本語", "🙂🙂 ok", "\0a\0", "aaaa" * 500, "the end\n\nof  it"]
    texts += ["".join(r.choice("ab \n▁🙂éxйthe 日") for _ in range(r.randint(1, 60))) for _ in range(1500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None), (0, "")], "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    found = tokens.tokens_query(docs).collect()
    assert len(found) == len(texts) + 2
    for x in found:
        want = texts[x.doc_id] if x.doc_id is not None else ""
        assert x.n_tokens == len(tokenizer.encode(want, add_special_tokens=False).ids)
    assert tokens.tokens_query(docs.limit(0)).collect() == []


def test_ties_and_unknown_characters_follow_the_tokenizer():
    pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, models, pre_tokenizers

    r = random.Random(7)
    for with_bytes in (False, True):
        for _ in range(40):
            pieces = {"".join(r.choice("ab▁cd") for _ in range(r.randint(1, 3))) for _ in range(8)}
            pieces = sorted(p for p in pieces if "▁" not in p[1:])
            scored = [(p, float(-r.randint(1, 3))) for p in pieces]
            extra = [("<unk>", 0.0)] + ([(f"<0x{i:02X}>", 0.0) for i in range(256)] if with_bytes else [])
            t = Tokenizer(models.Unigram(extra + scored, unk_id=0, byte_fallback=with_bytes))
            t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
            c = tokens.Counter(tokens.Vocabulary(tuple(scored), with_bytes, min([0.0, *(s for _, s in scored)])))
            for _ in range(30):
                text = "".join(r.choice("abcd eé") for _ in range(r.randint(1, 12)))
                assert c.count(text) == len(t.encode(text, add_special_tokens=False).ids), (scored, text)


def test_few_labels_leave_the_texts_where_they_are(spark):
    """Also where the planner's own limit is below the size of the labels."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(0, 200, 3)], "doc_id long, quality int, toxic int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = toxicity.training_rows(docs, labels)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        found = sorted(map(tuple, rows.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert found == sorted((f"text {i}", i % 2) for i in range(0, 200, 3) if zlib.crc32(str(i).encode()) % 5)
