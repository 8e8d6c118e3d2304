"""Secret scan: candidates by shape and by context, false positives removed by a random forest; DataFrame functions and
Spark ML only. A candidate is a long token anywhere, and a value of any length in an assignment or a URL.

The forest is trained on labelled findings made by rule from `spark.range` (kinds of credentials and of look-alikes,
with the words that stand beside them), since the tables hold no labels for secrets. Features of a candidate: length,
character transitions and classes, share covered by dictionary words, path, neighbouring words.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.line_chunks import let

#: What separates tokens beside a candidate.
SEPARATOR = r"[^A-Za-z0-9_+/.@\-]+"
EDGES = r"^[.@/+\-]+|([!?#$%&*~^])\1+$|[.@/+\-]+$"
TRAILING = r"[,;.)\]}>]+$"
_PARAMETER = r"[?&][\w.%\-]+="
_SECRET_NAME = r"(?i:passwords?|passwd|passcode|passphrase|pwd|secret|token|key|credentials?)"
#: (context, value): the first that fits at a place; a value holds any characters but those that end it there.
CONTEXTS = (
    (r"://[^\s/:@]*:(?=[^\s/]+@)", r"[^\s/]+(?=@)"),                              # password of a URL
    (_PARAMETER, r"[^\s&#\"'<>]+"),                                              # parameter of a URL
    (r"(?i:pass[ _-]?phrase)[\"']?[ \t]*(?::=|=>|[:=])[ \t]*(?![\"'\s])", r"[^\n\"']+"),
    (r"(?<=[\w\"'\])])[ \t]*(?::=|=>|=|:(?!//))[ \t]*\"", r"[^\"\n]+(?=\")"),
    (r"(?<=[\w\"'\])])[ \t]*(?::=|=>|=|:(?!//))[ \t]*'", r"[^'\n]+(?=')"),
    (r"(?<=[\w\"'\])])[ \t]*(?::=|=>|=|:(?!//))[ \t]*", r"[^\s\"'=][^\s\"']*+"),
    (rf"(?<![A-Za-z]){_SECRET_NAME}[ \t]+is[ \t]+[\"']?", r"[^\s\"']+"),
    (r"(?<![A-Za-z0-9_+/.@\-!#$%&*~^?])", rf"(?:(?!{_PARAMETER})[A-Za-z0-9_+/.@\-!#$%&*~^?]){{16,}}+"),
)
#: Noncharacters that stand around values (and before those without a context) while a text is taken apart.
MARKS = "\ufdd0\ufdd1"
FOUND = r"(?s)\G(.*?)(?:" + "|".join(f"(?:({context})({value}))" for context, value in CONTEXTS) + ")"
_GROUPS = [f"${k}" for k in range(1, 2 * len(CONTEXTS) + 2)]
MARKED = f"$1{''.join(_GROUPS[1::2])}{MARKS[0]}{''.join(_GROUPS[2:-1:2])}{MARKS[1]}{_GROUPS[-1]}{MARKS[0]}"
SHAPE = r"[A-Za-z0-9_+/.@\-!#$%&*~^?]{16,}|[:=]|(?i:\bis\b)"
#: Characters beside a candidate in which its neighbouring words are looked for.
BESIDE = 200
#: Texts are cut into blocks of this many characters, so that a part is taken without counting from the first character.
BLOCK = 1024
#: A found value of this length is hidden wherever it stands in its text; a shorter one, which may be a common word, where it was found.
UNIQUE_LEAST = 16
CANDIDATE_LEAST = 16
NEIGHBOURS = 4

# Words whose letters in a candidate speak for text or an identifier.
DICTIONARY = (
    "access account action address admin after again agent allow alpha amount answer application archive array author "
    "background backup banner before benchmark beta between binary block board boolean border branch browser bucket buffer "
    "build button cache call cancel canvas change channel check class clean client clock close cloud cluster code color column "
    "command comment commit common compile complete component config connect console constant container content context control "
    "convert copy core count create current custom data date debug default delete demo deploy depth description device dialog "
    "directory display document domain double download driver dummy dynamic edit element email enable encode engine entry error "
    "event example execute export extension factory false feature field file filter final first fixture folder font format frame "
    "from function global graph group handler header height hello home host html image import index info init input insert "
    "install instance integer internal item java json label language layout length level library license light line link list "
    "load local location lock login main make manager master match maximum memory message method minimum mobile mode model "
    "module monitor mouse name native network node number object offset open operator option order output package page panel "
    "parent parse password path pattern person picture place placeholder plugin point policy position post prefix preview price "
    "private process product profile program project property protocol public query queue random range read record region "
    "release remote remove render replace report request reset resource response result return root route sample scale schema "
    "screen script search secret section select server service session settings shadow shape simple single size socket source "
    "space start state static status step storage store stream string style submit success summary support switch system table "
    "target task template test text theme thread time title token tool total track transfer tree true type unit update upload "
    "user util value variable vector version video view visible warning width window word work world write your").split()
SECRET_WORDS = ("api apikey auth authorization bearer cert credential credentials key keys login pass passphrase passwd "
                "password private pwd secret secrets signing token tokens webhook").split()
PLAIN_WORDS = ("account at build card checksum commit contact digest email etag file from guid hash id image invoice isbn mail md5 number "
               "order path phone ref release request revision sample serial session sha sha1 sha256 trace tree url user uuid version "
               "with write").split()
PLACEHOLDERS = "example sample placeholder changeme dummy fake redacted xxxx your_ your- here foobar 12345678 abcdefgh".split()
PATH_WORDS = "test tests example examples sample samples fixture fixtures mock doc docs demo".split()

FEATURES = ("length", "digits", "uppers", "lowers", "marks", "hex_only", "class_changes", "vowel_changes", "distinct",
            "longest_digits", "longest_letters", "dictionary", "placeholder", "has_at", "slashes", "dots", "dashes", "known_prefix",
            "secret_near", "secret_next", "plain_near", "plain_next", "test_path")

def _any(words: list[str]) -> str:
    return "|".join(words)


def blocks_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part_of(blocks: Column, start: Column, size: Column) -> Column:
    """`size` characters from `start`, counted from 0, or as many as there are; reads the blocks they lie in."""
    first = F.floor(start / BLOCK).cast("int")
    spanned = F.slice(blocks, first + 1, F.floor((start + size) / BLOCK).cast("int") - first + 1)
    return F.substring(F.array_join(spanned, ""), start - first * BLOCK + 1, size)


def running_sums(sizes: Column) -> Column:
    """Sums of every element and those before it, in rounds that each add the sum of twice as many: n log n steps."""
    def widened(sums: Column, level: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), level)), F.lit(0)))

    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(sizes)))), sizes, widened)


def candidates(text: Column) -> Column:
    """Array of (token_no, start, value, before, after): candidates, their places and the words around them."""

    def pieces_of(pieces: Column) -> Column:
        return F.filter(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, F.struct(
            F.get(pieces, i - 1).alias("ahead"), F.translate(p, MARKS[1], "").alias("raw"), p.startswith(MARKS[1]).alias("token")))), lambda f: f.isNotNull())

    def words(part: Column) -> Column:
        return F.filter(F.split(F.lower(part), SEPARATOR, -1), lambda w: w != "")

    def tally(sums: Column, k: Column) -> Column:
        return F.coalesce(F.get(sums, k - 1), F.lit(0))

    def of(found: Column, blocks: Column) -> Column:
        lengths = F.transform(found, lambda f: F.length(f["ahead"]) + F.length(f["raw"]))
        separators = F.transform(found, lambda f: F.size(F.regexp_extract_all(F.concat(f["ahead"], f["raw"]), F.lit(SEPARATOR), F.lit(0))))

        def numbered(sizes: Column) -> Column:
            def one(f: Column, k: Column) -> Column:
                cut_front = F.when(f["token"], F.regexp_replace(f["raw"], r"^[.@/+\-]+", "")).otherwise(f["raw"])
                value = F.when(f["token"], F.regexp_replace(f["raw"], EDGES, "")).otherwise(F.regexp_replace(f["raw"], TRAILING, ""))
                start = tally(sizes["lengths"], k) + F.length(f["ahead"]) + F.length(f["raw"]) - F.length(cut_front)
                number = tally(sizes["separators"], k) + F.size(F.regexp_extract_all(f["ahead"], F.lit(SEPARATOR), F.lit(0)))
                return F.struct(number.cast("int").alias("token_no"), start.cast("int").alias("start"), value.alias("value"),
                                ((value != "") & (~f["token"] | (F.length(value) >= CANDIDATE_LEAST))).alias("fits"))

            def beside(c: Column) -> Column:
                first = F.greatest(c["start"] - BESIDE, F.lit(0))
                before = F.reverse(F.slice(F.reverse(words(part_of(blocks, first, c["start"] - first))), 1, NEIGHBOURS))
                after = F.slice(words(part_of(blocks, c["start"] + F.length(c["value"]), F.lit(BESIDE))), 1, 2)
                return F.struct(c["token_no"], c["start"], c["value"], F.array_join(before, " ").alias("before"), F.array_join(after, " ").alias("after"))

            return F.transform(F.filter(F.transform(found, one), lambda c: c["fits"]), beside)

        return let(F.struct(running_sums(lengths).alias("lengths"), running_sums(separators).alias("separators")), numbered)

    marked = F.regexp_replace(F.translate(text, MARKS, "\ufffd\ufffd"), FOUND, MARKED)
    pieces = let(F.split(marked, MARKS[0], -1), pieces_of)
    return let(F.struct(pieces.alias("found"), blocks_of(text).alias("blocks")), lambda parts: of(parts["found"], parts["blocks"]))


def with_features(findings: DataFrame) -> DataFrame:
    """Adds the features of (value, before, after, path)."""
    value, lowered = F.col("value"), F.lower("value")
    length = F.length(value).cast("double")

    def left(pattern: str, of: Column = value) -> Column:
        return F.length(F.regexp_replace(of, pattern, "")).cast("double")

    def longest(pattern: str) -> Column:
        runs = F.regexp_extract_all(value, F.lit(f"({pattern}+)"))
        return F.coalesce(F.array_max(F.transform(runs, lambda r: F.length(r))), F.lit(0)).cast("double")

    def changes(pattern: str, of: Column = value) -> Column:
        return F.size(F.regexp_extract_all(of, F.lit(pattern), 0)) / length

    # words before another value speak for that one
    before = F.regexp_replace("before", r"^.*(?<!\S)(?=\S{16,})\S*[0-9]\S*( |$)", "")
    near = F.concat_ws(" ", before, "after")
    last = F.substring_index(before, " ", -2)
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    word = lambda words: rf"(^|[^a-z])({_any(words)})([^a-z]|$)"
    return findings.withColumns({
        "length": F.least(length, F.lit(400.0)),
        "digits": 1 - left("[0-9]") / length, "uppers": 1 - left("[A-Z]") / length, "lowers": 1 - left("[a-z]") / length,
        "marks": left("[A-Za-z0-9]") / length,
        "hex_only": flag(lowered.rlike("^[0-9a-f]+$") & value.rlike("[0-9]") & lowered.rlike("[a-f]")),
        "class_changes": changes("(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[0-9]|(?<=[0-9])[A-Za-z]"),
        "vowel_changes": changes("(?<=[aeiou])[b-df-hj-np-tv-z]", lowered),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(length, F.lit(64.0)),
        "longest_digits": longest("[0-9]") / length, "longest_letters": longest("[A-Za-z]") / length,
        "dictionary": 1 - left(f"({_any(sorted((w for w in DICTIONARY if len(w) > 3), key=len, reverse=True))})", lowered) / length,
        "placeholder": flag(lowered.rlike(f"{_any(PLACEHOLDERS)}") | value.rlike(r"(.)\1{5,}")),
        "has_at": flag(value.contains("@")), "slashes": 1 - left("/") / length, "dots": 1 - left("[.]") / length, "dashes": 1 - left("-") / length,
        "known_prefix": flag(value.rlike("^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk-|sk_live_|rk_live_|xox[abprs]-|AIza|SG[.]|npm_|eyJ)")),
        "secret_near": flag(before.rlike(word(SECRET_WORDS)) | F.regexp_replace(before, "_", " ").rlike(word(SECRET_WORDS))),
        "secret_next": flag(F.regexp_replace(last, "[_.]", " ").rlike(word(SECRET_WORDS))),
        "plain_near": flag(near.rlike(word(PLAIN_WORDS))), "plain_next": flag(last.rlike(word(PLAIN_WORDS))),
        "test_path": flag(F.lower("path").rlike(word(PATH_WORDS))),
    })


def labelled_findings(spark: SparkSession, rows: int = 5000, seed: int = 5) -> DataFrame:
    """(value, before, after, path, label): `rows` findings of credentials (1) and of look-alikes (0), made by rule."""

    def draw(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(name), F.lit(seed)), F.lit(n)).cast("int")

    def pick(name: str, words: list[str]) -> Column:
        return F.array(*(F.lit(w) for w in words))[draw(name, len(words))]

    def digest(name: str) -> Column:
        return F.sha2(F.concat_ws("-", F.lit(f"{name}{seed}"), F.col("id").cast("string")), 512)

    def letters(name: str, alphabet: str, n: Column | int) -> Column:
        bytes_ = F.sequence(F.lit(0), (F.lit(n) if isinstance(n, int) else n) - 1)
        at = lambda i: F.pmod(F.xxhash64("id", F.lit(name), F.lit(seed), i), F.lit(len(alphabet))).cast("int") + 1
        return F.array_join(F.transform(bytes_, lambda i: F.substring(F.lit(alphabet), at(i), F.lit(1))), "")

    upper, lower, digit = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    any_char, cat = upper + lower + digit, lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    hex_of = lambda name: F.substring(digest(name), F.lit(1), F.array(*(F.lit(n) for n in (32, 40, 64, 40)))[draw("hex", 4)])
    words = [w for w in DICTIONARY if len(w) > 3]
    secrets = [
        hex_of("a"), hex_of("b"), letters("mix", any_char, draw("n", 40) + 20), letters("mix2", any_char + "+/", 40), letters("mix3", any_char + "_-", draw("n2", 60) + 24),
        cat("AKIA", letters("aws", upper + digit, 16)), cat("ghp_", letters("gh", any_char, 36)), cat("sk-", letters("sk", any_char, 48)),
        cat("xoxb-", letters("x1", digit, 12), "-", letters("x2", any_char, 24)), cat("AIza", letters("g", any_char + "_-", 35)),
        letters("pw", any_char + "@_-", draw("n3", 8) + 16), letters("short", any_char + "!#$%&*~:=?", draw("n6", 9) + 8),
        cat(pick("h1", words), letters("h2", digit, 1), letters("h3", "!#$%&*~", 1), letters("h4", lower, 1)), cat(pick("h5", words), letters("h6", digit, draw("n7", 3) + 2)),
        cat(pick("q1", words), letters("q5", " -", 1), pick("q2", words), " ", pick("q3", words), " ", pick("q4", words)),
        cat(pick("q1", words), pick("q2", words), pick("q3", words), pick("q4", words))]
    split_digest = lambda name: F.regexp_replace(F.substring(digest(name), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    plain = [
        letters("card", digit, 16), letters("num", digit, draw("n4", 10) + 16), split_digest("u"), split_digest("u2"),
        cat(letters("m1", lower, draw("n5", 12) + 5), ".", letters("m2", digit, 2), "@", pick("m3", ["mail", "post", "corp"]), letters("m4", digit, 1), ".example.com"),
        cat(F.initcap(pick("w1", words)), F.initcap(pick("w2", words)), F.initcap(pick("w3", words)), F.initcap(pick("w4", words))),
        cat(pick("w1", words), "_", pick("w2", words), "_", pick("w3", words), "_", letters("d", digit, 1)),
        cat("/usr/", pick("w1", words), "/", pick("w2", words), "/", pick("w3", words), letters("d2", digit, 1), ".", pick("ext", ["py", "txt", "js"])),
        cat("www.", pick("w1", words), pick("w2", words), letters("d3", digit, 1), ".com/", pick("w3", words)),
        cat("2021-0", letters("y", "123456789", 1), "-1", letters("y2", digit, 1), "T0", letters("y3", digit, 1), ".00.00Z"),
        cat(pick("w1", words), "-", pick("w2", words), "-", letters("v", digit, 1), ".", letters("v2", digit, 2), ".", letters("v3", digit, 1)),
        cat("your_", pick("w1", words), "_", pick("sw", ["key", "token", "secret"]), "_here"), F.lit("xxxxxxxxxxxxxxxxxxxxxxxx"),
        cat("example", letters("e", any_char, 12)),
        pick("v1", words), letters("v4", digit, draw("n8", 6) + 1), letters("v5", lower, draw("n9", 12) + 2), cat(pick("v6", words), " ", pick("v7", words)),
        cat(letters("t1", digit, 2), ":", letters("t2", digit, 2)), cat(pick("v8", words), "-", pick("v9", words), "-", pick("v10", words)),
        letters("v11", lower, draw("n10", 10) + 16), cat(letters("v12", digit, 1), ".", letters("v13", digit, 2)), F.initcap(pick("v14", words)),
        letters("u3", upper, draw("n11", 20) + 8), F.upper(cat(pick("u4", words), pick("u5", words), pick("u6", words))),
        cat(letters("u7", upper, draw("n12", 20) + 8), letters("u8", ".!?", 1)), F.initcap(letters("u9", lower, draw("n13", 20) + 8)),
        F.substring(digest("c"), 1, 40), F.substring(digest("c2"), 1, 40), F.substring(digest("c3"), 1, 64)]
    secret = draw("label", 2) == 1
    filler = [*words[:60], "the", "of", "and", "is", "to", "la", "de", "und", "der", "que"]
    hash_like = draw("plain", len(plain)) >= len(plain) - 3
    beside = (F.when(secret & (draw("near", 10) > 0), pick("s", [*SECRET_WORDS, "api_key", "access_token", "client_secret", "db_password", "auth_token"]))
              .when(secret, pick("f0", filler)).when(hash_like, pick("p", ["commit", "sha256", "sha1", "md5", "checksum", "digest", "etag", "revision", "tree", "hash"]))
              .when(draw("near", 10) > 3, pick("f1", filler)).otherwise(pick("p2", PLAIN_WORDS)))
    kinds = lambda name, of: F.array(*of)[draw(name, len(of))]
    return spark.range(rows).select(
        F.when(secret, kinds("secret", secrets)).otherwise(kinds("plain", plain)).alias("value"),
        F.concat_ws(" ", F.when(draw("far", 4) == 0, pick("fs", SECRET_WORDS)).otherwise(pick("f2", filler)),
                    F.when(draw("far2", 6) == 0, pick("fs2", [*SECRET_WORDS, *PLAIN_WORDS])).otherwise(pick("f3", filler)), pick("f4", filler), beside).alias("before"),
        F.concat_ws(" ", pick("f5", filler), pick("f6", filler)).alias("after"),
        F.when(draw("path", 6) == 0, pick("pw2", ["src/test/a.py", "docs/example.md", "tests/fixtures.json"])).otherwise(pick("pw3", ["src/main.py", "src0", "web/app.js", ""])).alias("path"),
        secret.cast("double").alias("label"))


def train(spark: SparkSession, rows: int = 5000, trees: int = 40, depth: int = 8, seed: int = 5) -> PipelineModel:
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    found = with_features(labelled_findings(spark, rows, seed)).select(*FEATURES, "label").coalesce(1).cache()
    try:
        return Pipeline(stages=[assembler, forest]).fit(found)
    finally:
        found.unpersist()


def scan(docs: DataFrame, model: PipelineModel | None = None, threshold: float = 0.5, id_col: str = "doc_id",
         text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: doc_id, text_mark, token_no, start, value, probability, is_secret.

    `start` is the candidate's own place in the text, from 0; token_no counts separators before it; text_mark the 64-bit hash of the text, which tells
    rows of one id apart. Null and empty texts have no findings, a null path is an empty one, null ids are kept,
    repeated rows have findings each. Columns but id, text and path are not read.
    """
    spark = docs.sparkSession
    path = F.lit("") if path_col is None or path_col not in docs.columns else F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("body"), path.alias("path"))
    found = rows.where(F.col("body").rlike(SHAPE)).select(
        "doc_id", F.xxhash64("body").alias("text_mark"), "path", F.explode(candidates(F.col("body"))).alias("c"))
    found = found.select("doc_id", "text_mark", "path", "c.*")
    scored = (model or train(spark)).transform(with_features(found))
    chance = vector_to_array("probability")[1]
    return scored.select("doc_id", "text_mark", "token_no", "start", "value", F.round(chance, 6).alias("probability"),
                         (chance >= threshold).alias("is_secret"))


def redact(docs: DataFrame, model: PipelineModel | None = None, mark: str = "[secret]", id_col: str = "doc_id",
           text_col: str = "text", path_col: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """`docs` with every found secret replaced by `mark` in its text; all rows stay, also without id or text. Names that begin with
    `_sc_` are taken. Long values are looked for in the whole text, once for each distinct one."""
    spark = docs.sparkSession
    path = F.lit("") if path_col is None or path_col not in docs.columns else F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    keyed = docs.withColumns({"_sc_id": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "_sc_mark": F.xxhash64(F.col(text_col))})
    found = keyed.where(F.col(text_col).rlike(SHAPE)).select(
        "_sc_id", "_sc_mark", path.alias("path"), F.explode(candidates(F.col(text_col))).alias("c")).select("_sc_id", "_sc_mark", "path", "c.*")
    scored = (model or train(spark)).transform(with_features(found)).where(vector_to_array("probability")[1] >= threshold)
    spans = scored.groupBy("_sc_id", "_sc_mark").agg(F.array_sort(F.collect_set(F.struct("start", "value"))).alias("_sc_spans"))  # of one document
    text, own, blocks = F.col(text_col), F.col("_sc_spans"), F.col("_sc_blocks")
    end = lambda s: s["start"] + F.length(s["value"])
    between = F.transform(own, lambda s, k: let(F.when(k == 0, 0).otherwise(end(F.get(own, k - 1))), lambda last: F.concat(
        part_of(blocks, last, s["start"] - last), F.lit(mark))))
    hidden = F.concat(F.array_join(between, ""), part_of(blocks, end(F.element_at(own, -1)), F.length(text) - end(F.element_at(own, -1))))
    unique = F.array_distinct(F.filter(F.transform(own, lambda s: s["value"]), lambda v: F.length(v) >= UNIQUE_LEAST))
    longest = F.array_sort(unique, lambda a, b: F.length(b) - F.length(a))
    cleaned = F.aggregate(longest, hidden, lambda t, v: F.replace(t, v, F.lit(mark)))
    return (keyed.join(spans, ["_sc_id", "_sc_mark"], "left").withColumn("_sc_blocks", F.when(own.isNotNull(), blocks_of(text)))
            .withColumn(text_col, F.when(own.isNull(), text).otherwise(cleaned)).select(docs.columns))
