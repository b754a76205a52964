"""Text analysis: tokenizer, folding, Porter stemmer, chain order (TXT-*)."""

import pytest
from pyspark.sql import functions as F

from docforge.functions import hungarian
from docforge.functions.text import analyze_tokens, stem_column
from docforge.operators.analysis import analyzed_fields
from docforge.spec import AnalyzerSpec, FieldSpec

# Published Porter (1980) examples plus the README sentence.
PAIRS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "digitizer": "digit", "conformabli": "conform",
    "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
    "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
    "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ",
    "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "running": "run", "villages": "villag", "village": "villag",
    "kovacs": "kovac", "through": "through", "yelling": "yell", "by": "by", "archaeology": "archaeolog",
}


def test_porter_pairs(spark):
    df = spark.createDataFrame([(w,) for w in PAIRS], "token string")
    got = {r["w"]: r["token"] for r in stem_column(df.withColumn("w", F.col("token")), "token").collect()}
    wrong = {w: (got[w], s) for w, s in PAIRS.items() if got[w] != s}
    assert not wrong


GERMAN_PAIRS = {  # published vocabulary and output of the Snowball stemmer
    "aufeinander": "aufeinand", "aufeinanderfolge": "aufeinanderfolg", "aufeinanderfolgen": "aufeinanderfolg",
    "aufeinanderfolgend": "aufeinanderfolg", "aufeinanderfolgende": "aufeinanderfolg", "aufeinanderfolgt": "aufeinanderfolgt",
    "aufeinanderfolgten": "aufeinanderfolgt", "auferlegen": "auferleg", "auferlegt": "auferlegt", "auferlegten": "auferlegt",
    "auferstanden": "auferstand", "auferstehen": "aufersteh", "aufersteht": "aufersteht", "auferstehung": "aufersteh",
    "kategorie": "kategori", "kategorien": "kategori", "kategorisch": "kategor", "kategorische": "kategor",
    "kategorischen": "kategor", "kategorischer": "kategor", "kater": "kat", "katers": "kat", "kathedrale": "kathedral",
    "katholisch": "kathol", "katze": "katz", "katzen": "katz", "kauen": "kau", "kaufen": "kauf", "kauft": "kauft", "käufer": "kauf",
    "häuser": "haus", "kenntnisse": "kenntnis", "größe": "gross", "frauen": "frau", "ab": "ab",
}


SPANISH_PAIRS = {  # published vocabulary and output, and cases of single rules
    "che": "che", "cheque": "chequ", "cheques": "chequ", "chico": "chic", "chicas": "chic", "chicharrones": "chicharron",
    "chihuahua": "chihuahu", "chinas": "chin", "chispas": "chisp", "chocolate": "chocolat", "torneado": "torn", "torneo": "torne",
    "toreado": "tor", "toreándolo": "tor", "torear": "tor", "toreara": "tor", "toreros": "torer", "tormentas": "torment",
    "toronto": "toront", "tortura": "tortur", "torturado": "tortur", "torturadas": "tortur", "torturarán": "tortur",
    "rápidamente": "rapid", "nación": "nacion", "administración": "administr", "biología": "biolog", "felicidad": "felic",
    "instituciones": "institu", "paguen": "pag", "contribuyendo": "contribu", "amable": "amabl",
}


def test_spanish_pairs(spark):
    df = spark.createDataFrame([(w, w) for w in SPANISH_PAIRS], "w string, token string")
    got = {r["w"]: r["token"] for r in stem_column(df, "token", language="spanish").collect()}
    assert {w: (got[w], s) for w, s in SPANISH_PAIRS.items() if got[w] != s} == {}


# Published sample vocabulary
FRENCH_PAIRS = dict(p.split(":") for p in (
    "continu:continu continua:continu continuait:continu continuant:continu continuation:continu continue:continu continué:continu "
    "continuel:continuel continuelle:continuel continuellement:continuel continuelles:continuel continuels:continuel continuer:continu "
    "continuera:continu continuerait:continu continueront:continu continuez:continu continuité:continu continuons:continuon "
    "contorsions:contors contour:contour contournait:contourn contournant:contourn contourne:contourn contours:contour "
    "contractait:contract contracté:contract contractée:contract contracter:contract contractés:contract contractions:contract "
    "contradictoirement:contradictoir contradictoires:contradictoir contraindre:contraindr contraint:contraint contrainte:contraint "
    "contraintes:contraint contraire:contrair contraires:contrair contraria:contrari main:main mains:main maintenaient:mainten "
    "maintenait:mainten maintenant:mainten maintenir:mainten maintenue:maintenu maintien:maintien maintint:maintint maire:mair "
    "maires:mair mairie:mair mais:mais maison:maison maisons:maison maistre:maistr maitre:maitr maître:maîtr maîtres:maîtr "
    "maîtresse:maîtress maîtresses:maîtress majesté:majest majestueuse:majestu majestueusement:majestu majestueux:majestu "
    "majeur:majeur majeure:majeur major:major majordome:majordom majordomes:majordom majorité:major majorités:major mal:mal "
    "malacca:malacc malade:malad malades:malad maladie:malad maladies:malad maladive:malad").split())

# Traced by hand through the published rules: cases, lengthened vowels, doubled consonants, owners, plurals
HUNGARIAN_PAIRS = dict(p.split(":") for p in (
    "babakocsi:babakocs babakocsit:babakocs babakocsijáért:babakocs babból:bab házban:ház házakban:ház házat:ház kutyák:kutya kutyánként:kuty "
    "almát:alm almákat:alma virággal:virág késsel:kés kézzel:kéz meggyel:megy barátom:barát barátaim:barát barátainknak:barát "
    "embereknek:ember városban:város városokból:város emberként:ember körül:kör").split())


@pytest.mark.parametrize("language, pairs", [("french", FRENCH_PAIRS), ("hungarian", HUNGARIAN_PAIRS)])
def test_compiled_rules(spark, language, pairs):
    df = spark.createDataFrame([(w, w) for w in pairs], "w string, token string")
    got = {r["w"]: r["token"] for r in stem_column(df, "token", language=language).collect()}
    assert {w: (got[w], s) for w, s in pairs.items() if got[w] != s} == {}


def _hungarian(word):
    """The algorithm as a plain program over one word."""
    vowels, start = hungarian.VOWELS, len(word)
    first = next((i for i, c in enumerate(word) if (c in vowels) != (word[0] in vowels)), None)
    if first is not None:
        start = first + 1
        if word[0] in vowels:
            start = first + max([len(g) for g in hungarian.DIGRAPHS.split("|") if word.startswith(g, first)], default=1)

    def step(word, table, twice=False):
        found = max((e for e in table if word.endswith(e)), key=len, default=None)
        if found is None or len(word) - len(found) < start:
            return word, False
        head = word[: len(word) - len(found)]
        if twice:
            return (head[:-2] + head[-1], True) if head.endswith(tuple(hungarian.DOUBLED.split("|"))) else (word, False)
        return head + table[found], True

    def table(gone, to_a="", to_e=""):
        return {e: "" for e in gone.split()} | {e: "a" for e in to_a.split()} | {e: "e" for e in to_e.split()}

    word, _ = step(word, table("al el"), twice=True)
    word, cut = step(word, table(hungarian.CASES))
    if cut:
        word, _ = step(word, table("", "á", "é"))
    word, _ = step(word, table("", "án ánként", "én"))
    word, _ = step(word, table("astul estül stul stül", "ástul", "éstül"))
    word, _ = step(word, table("á é"), twice=True)
    word, _ = step(word, table(hungarian.OWNED, "áké áéi", "éké ééi éé"))
    word, _ = step(word, table(hungarian.SING_OWNER, "ánk ájuk ám ád á", "énk éjük ém éd é"))
    word, _ = step(word, table(hungarian.PLUR_OWNER, "áim áid ái áink áitok áik", "éim éid éi éink éitek éik"))
    return step(word, table(hungarian.PLURAL, "ák", "ék"))[0]


def test_hungarian_against_plain_program(spark):
    stems = "alma kutya ház édzs asszony kéz meggy rizzs út ő x barát ifjú lény 12 dzsessz".split()
    ends = " ".join((hungarian.CASES, hungarian.OWNED, hungarian.SING_OWNER, hungarian.PLUR_OWNER, hungarian.PLURAL, "al el á é án én ánként ástul éstül stul")).split()
    words = sorted({s + a + b for s in stems for a in ["", *ends] for b in ["", "k", "át", "ekkel", "ért", "é"]})
    df = spark.createDataFrame([(w, w) for w in words], "w string, token string")
    got = {r["w"]: r["token"] for r in stem_column(df, "token", language="hungarian").collect()}
    assert {w: (got[w], _hungarian(w)) for w in words if got[w] != _hungarian(w)} == {}


def test_german_pairs(spark):
    df = spark.createDataFrame([(w, w) for w in GERMAN_PAIRS], "w string, token string")
    got = {r["w"]: r["token"] for r in stem_column(df, "token", language="german").collect()}
    assert {w: (got[w], s) for w, s in GERMAN_PAIRS.items() if got[w] != s} == {}


def _tokens(spark, text, analyzer):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    rows = analyze_tokens(df, ["id"], "text", analyzer).orderBy("position").collect()
    return [r["token"] for r in rows]


def test_readme_sentence_standard_and_custom(spark):
    sentence = "Running through Kovács' villages"
    assert _tokens(spark, sentence, AnalyzerSpec()) == ["running", "through", "kovács", "villages"]
    assert _tokens(spark, sentence, AnalyzerSpec("english")) == ["run", "through", "kovac", "villag"]


def test_folding_off_keeps_accents(spark):
    assert _tokens(spark, "Kovács' villages", AnalyzerSpec("english", ascii_folding=False)) == ["kovác", "villag"]


def test_no_language_is_noop_even_with_folding(spark):
    assert AnalyzerSpec(None).filters() == []
    assert AnalyzerSpec("").filters() == []
    assert AnalyzerSpec("english").filters() == ["lowercase", "asciifolding", "stemmer"]
    assert AnalyzerSpec("english", ascii_folding=False).filters() == ["lowercase", "stemmer"]
    assert _tokens(spark, "Kovács", AnalyzerSpec("", ascii_folding=True)) == ["kovács"]


def test_unsupported_language_raises(spark):
    with pytest.raises(NotImplementedError):
        _tokens(spark, "x", AnalyzerSpec("basque"))


def test_tokenizer_keeps_inner_apostrophe_and_decimals(spark):
    assert _tokens(spark, "can't pay 3.14 e.g. U.S.A. end.", AnalyzerSpec()) == \
        ["can't", "pay", "3.14", "e.g", "u.s.a", "end"]


def test_only_text_fields_analysed(spark):
    # FIXTURES A3: title text(+keyword), tags keyword, year long, released date
    df = spark.createDataFrame([("1", "Running Shoes", "Running Shoes", 2020)],
                               "id string, title string, tags string, year long")
    mapping = {"title": FieldSpec("text", True), "tags": FieldSpec("keyword"), "year": FieldSpec("long"),
               "released": FieldSpec("date")}
    rows = analyzed_fields(df, "id", mapping, AnalyzerSpec("english")).collect()
    got = sorted((r["field"], r["position"], r["term"]) for r in rows)
    assert got == [("tags", 0, "Running Shoes"), ("title", 0, "run"), ("title", 1, "shoe"),
                   ("title.keyword", 0, "Running Shoes"), ("year", 0, "2020")]


def test_curly_apostrophe_joins_like_ascii(spark):
    assert _tokens(spark, "Don’t stop", AnalyzerSpec()) == ["don’t", "stop"]


WORDS = {  # lines of the annex's own examples and of its test data
    "The quick (“brown”) fox can't jump 32.3 feet, right?": ["the", "quick", "brown", "fox", "can't", "jump", "32.3", "feet", "right"],
    "3,000 1,2;3 a,b a.b a.1 1.a 1..2 a..b a:b 1:2": ["3,000", "1,2;3", "a", "b", "a.b", "a", "1", "1", "a", "1", "2", "a", "b", "a:b", "1", "2"],
    "漢字かなカタカナabc漢 한국어": ["漢", "字", "か", "な", "カタカナ", "abc", "漢", "한국어"],
    "_a_ ___ a_b テスト_x": ["_a_", "a_b", "テスト_x"],
    "a🙂b 👩‍👩‍👧‍👦👍🏽 🇩🇪🇫🇷 ☺️ ☺ 1️⃣": ["a", "🙂", "b", "👩‍👩‍👧‍👦", "👍🏽", "🇩🇪", "🇫🇷", "☺️", "1️⃣"],
    "été co­op a‍b नमस्ते ภาษาไทย ok": ["été", "co­op", "a‍b", "नमस्ते", "ภาษาไทย", "ok"],
    "can’t rock'n'roll 'quoted' dogs' a' 'b": ["can’t", "rock'n'roll", "quoted", "dogs", "a", "b"],
    "": [], " ,.;:'_": [],
}


def test_words_follow_the_annex(spark):
    assert {text: _tokens(spark, text, AnalyzerSpec()) for text in WORDS} == WORDS


def test_very_long_words(spark):
    texts = ["a1" * 200_000, "a." * 100_000 + "b", "_" * 50_000 + " z", "漢" * 50_000, "👩‍" * 50_000, "á" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["n"] for r in analyze_tokens(df, ["id"], "text", AnalyzerSpec()).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 50_000, 4: 1, 5: 1}


FOLDED = {"nguyễn đặng": "nguyen dang", "ﬀ ﬁ ﬃ ĳ ǆ ꜳ": "ff fi ffi ij dz aa", "ｆｕｌｌ ｗｉｄｔｈ １２": "full width 12", "straße æther œuvre þorn": "strasse aether oeuvre thorn",
          "łódź ħal ŧ ø ı ŋ ð ſ ẛ": "lodz hal t o i n d s s", "kovács": "kovacs", "plain": "plain", "жук 漢 ǝ ß": "жук 漢 ǝ ss", "ª º ŉ ẚ": "a o n a", "": ""}


def test_folding_over_latin_blocks(spark):
    from docforge.functions.folding import TABLE, fold
    df = spark.createDataFrame([(t,) for t in FOLDED], "t string")
    assert {r["t"]: r["f"] for r in df.select("t", fold(F.col("t")).alias("f")).collect()} == FOLDED
    every = spark.createDataFrame(list(TABLE.items()), "c string, goal string")
    assert every.where(fold(F.concat(F.lit("x"), F.col("c"))) != F.concat(F.lit("x"), F.col("goal"))).count() == 0
    assert all(goal.isascii() and goal.isalnum() and goal == goal.lower() for goal in TABLE.values()) and len(TABLE) > 450


def test_ascii_texts_have_the_words_of_the_whole_rules(spark):
    import random

    from docforge.functions.words import ASCII_PATTERN, SPARK_PATTERN
    rng = random.Random(5)
    texts = ["".join(rng.choices("ab1_2.':,;#* -\n\t\x00~A", k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["__", "_a_", "a__b.c_.d", "3.14,5;6'7:8", "can't o'.x e.g. a.1 1.a", "a", "", "x_1.2_", "#1 *2*"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.lower("t").alias("l"))
    both = df.select("t", F.regexp_extract_all("l", F.lit(ASCII_PATTERN), 0).alias("a"), F.regexp_extract_all("l", F.lit(SPARK_PATTERN), 0).alias("b"))
    assert [tuple(r) for r in both.where("a <> b").limit(5).collect()] == []


def test_field_postings_are_the_analysed_fields(spark, tmp_path):
    from docforge.operators.analysis import field_postings, write_term_index

    english = AnalyzerSpec("english")
    mapping = {"t": FieldSpec("text", True), "k": FieldSpec("keyword"), "n": FieldSpec("long"), "none": FieldSpec("text"), "o": FieldSpec("object")}
    docs = spark.createDataFrame(
        [("1", "Running runs; ran, Kov\u00e1cs' villages village", "x", 1), ("2", None, None, None), ("3", "", "", 3), ("3", "runs 3.5", "x", 4),
         (None, "the run", "y", 5), ("4", " ".join(["word", "words"] * 400), "z", 6)], "id string, t string, k string, n long").repartition(2)
    frames = field_postings(docs, "id", mapping, english)
    assert set(frames) == {"t", "t.keyword", "k", "n"} and "postings" in frames["t"].columns
    # a word of a batch is one row, however often it is there
    assert frames["t"].groupBy("term").count().agg(F.max("count")).first()[0] <= 2 * 3
    write_term_index(frames, f"{tmp_path}/terms")
    order = ["id", "field", "position", "term"]
    got = spark.read.parquet(f"{tmp_path}/terms").select(*order).collect()
    want = analyzed_fields(docs, "id", mapping, english).select(*order).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) > 800
    rows = spark.read.parquet(f"{tmp_path}/terms/field=t").withColumn("f", F.input_file_name()).collect()  # files are sorted on the term
    for name in {r["f"] for r in rows}:
        terms = [r["term"] for r in rows if r["f"] == name]
        assert terms == sorted(terms)
    plain = field_postings(docs, "id", {"t": FieldSpec("text")}, AnalyzerSpec())["t"].select(F.inline("postings"), "term").select("id", "position", "term")
    other = analyzed_fields(docs, "id", {"t": FieldSpec("text")}, AnalyzerSpec()).select("id", "position", "term")
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, other.collect()))
