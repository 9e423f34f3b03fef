"""Secret scans with a random forest against false positives, in DataFrame functions only.

Candidates are what follows a secret's name and a sign of assignment, the password of a
URL, a private key's block, and long runs of key characters. The forest sees a
candidate's length, its character classes and transitions, how likely its letter pairs
are in prose, how much of it dictionary words cover, the path it is in and the words next
to it. Dictionary and letter pairs are fitted on the documents, the forest is trained
from labelled findings.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that a secret is assigned to, the sign, and quotes.
ASSIGNED = r"""(?i:passw(?:or)?d|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?key|auth|credential)s?["']?\s{0,3}(?::=|=>|[:=])\s{0,3}["'`]?(?i:bearer )?"""
BEARER = r"(?i:bearer) {1,3}"
URL = r"[a-z][a-z0-9+]{1,12}://[^\s:/@\"']{1,64}:"
BLOCK = r"-----BEGIN (?:[A-Z]{1,16} ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,16384}?-----END (?:[A-Z]{1,16} ){0,3}PRIVATE KEY-----"
#: A value of so many characters at least is a candidate where a name is assigned, and anywhere.
LEAST, LONG = 6, 16
CANDIDATE = "|".join([BLOCK, rf"{URL}[^\s/@\"']{{3,128}}@", rf"{ASSIGNED}[^\s\"'`,;<>(){{}}]{{{LEAST},512}}", rf"{BEARER}[A-Za-z0-9._~+/-]{{{LONG},512}}=*", rf"(?<![A-Za-z0-9_+/.-])[A-Za-z0-9_+/.-]{{{LONG},}}+={{0,2}}"])
PREFIX_OF = rf"^(?:{URL}(?=[^\s/@\"']{{3,128}}@$)|{ASSIGNED}|{BEARER})"
#: Words of the dictionary that is fitted, the most frequent ones.
DICTIONARY = 20_000

# Words that names, paths and placeholders are made of.
WORDS = (
    "account address admin alpha array author backup batch block build button cache call change changeme class client code column commit common config connect content context count create data date default delete demo "
    "document down dummy element email enable error event example fake field file filter find first format from function get group handler hash head header here home image index info input insert install item java key label "
    "last level library line link list load local log main manager map message method mock model module name node null number object option order output package page param parent parse path pattern placeholder player point "
    "process product project property public python query read record release remove report request reset resource response result return sample save schema search secret section select server service session set settings "
    "size source start state status step store stream string style sub system table target task template test text time title token total type unit update upload user util value version view web widget window with word write your"
).split()
# Words beside a secret, and beside digests that are none.
BESIDE = r"(?i)(secret|token|api.?key|passw|pwd|auth|bearer|credential|private|access.?key)"
BESIDE_OTHER = r"(?i)(commit|sha|md5|checksum|digest|uuid|guid|\bid\b|etag|revision|card|phone|isbn)"
PREFIX = r"^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abprs]-|sk_live_|sk-|AIza|eyJ|SG\.|npm_)"
TEST_PATH = r"(?i)(test|example|sample|mock|fixture|dummy|demo|docs?/)"

FEATURES = ("length", "digits", "uppers", "lowers", "transitions", "distinct", "unlikely", "dictionary", "hex", "prefix", "repeats", "separators", "assigned", "quoted", "beside", "beside_other", "test_path")


class Language:
    """What texts are made of: a set of words as bits, and the surprise of each pair of letters.

    Both are of a fixed size, 32 bits a word of the dictionary and 729 bytes, and go to
    the executors as literals of the plan.
    """

    def __init__(self, counts: dict[str, int]):
        known = {w.lower() for w in [*counts, *WORDS]}
        self.size = 32 * max(1, len(known))
        self.words = known
        pairs = Counter()
        for w, n in counts.items():
            own = f"{w}"
            for a, b in zip(own, own[1:], strict=False):
                pairs[self._letter(a), self._letter(b)] += n
        first = Counter()
        for (a, _), n in pairs.items():
            first[a] += n
        # in sixteenths of a bit, smoothed by one; without any text all pairs are alike
        self.surprise = bytes(min(255, round(-16 * math.log2((pairs[a, b] + 1) / (first[a] + 27)))) for a in range(27) for b in range(27))

    @staticmethod
    def _letter(c: str) -> int:
        return ord(c) - 97 if "a" <= c <= "z" else 26

    @classmethod
    def fit(cls, docs: DataFrame, text_col: str = "text", most: int = DICTIONARY) -> Language:
        """From the words of all whole texts: the `most` most frequent, so that much comes to the driver. Null texts have none."""
        words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(?<![\p{L}\p{N}])\p{L}{3,24}(?![\p{L}\p{N}])"), F.lit(0))).alias("word"))
        top = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "word").limit(most).collect()
        return cls({r["word"]: r["n"] for r in top})

    def bits(self, spark: SparkSession) -> bytearray:
        """The set of words as bits, by the hashes that has() asks for."""
        out = bytearray(self.size // 8)
        frame = spark.createDataFrame([(w,) for w in sorted(self.words)], "w string")
        for r in frame.select(*self._places(F.col("w"))).collect():
            for place in r:
                out[place // 8] |= 1 << place % 8
        return out

    def _places(self, word: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(word, F.lit(k)), F.lit(self.size)).alias(f"p{k}") for k in (1, 2, 3)]

    def has(self, word: Column, bits: Column) -> Column:
        out = F.lit(True)
        for place in self._places(word):
            byte = _byte(bits, F.floor(place / 8).cast("int"))
            out = out & (F.floor(byte / F.pow(F.lit(2.0), place % 8)).cast("int") % 2 == 1)
        return out


def _byte(of: Column, i: Column) -> Column:
    return F.conv(F.hex(F.substr(of, i + F.lit(1), F.lit(1))), 16, 10).cast("int")


def _share(s: Column, drop: str) -> Column:
    """Share of the characters that match a class."""
    return (F.length(s) - F.length(F.regexp_replace(s, drop, ""))) / F.greatest(F.length(s), F.lit(1))


def features(candidate: Column, before: Column, after: Column, path: Column, language: Language, bits: bytes | bytearray) -> list[Column]:
    low, n = F.lower(candidate), F.greatest(F.length(candidate), F.lit(1))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(candidate, "[0-9]+", "\u0001"), "[a-z]+", "\u0002"), "[A-Z]+", "\u0003"), "[^\u0001-\u0003]+", "\u0004")
    near = F.lower(F.substring(F.concat(F.lit(" " * 32), before), -32, 32))
    words = "|".join(sorted(WORDS, key=lambda w: (-len(w), w)))
    table, surprise = F.lit(bytes(bits)), F.lit(language.surprise)
    parts = F.filter(F.transform(F.regexp_extract_all(candidate, F.lit(r"\p{Lu}?\p{Ll}{2,}|\p{Lu}{3,}"), F.lit(0)), F.lower), lambda w: language.has(w, table))
    known = F.aggregate(parts, F.lit(0), lambda acc, w: acc + F.length(w)) / n
    letter = lambda c: F.when(c.rlike("[a-z]"), F.ascii(c) - 97).otherwise(26)
    codes = F.transform(F.filter(F.split(low, ""), lambda c: c != ""), letter)
    steps = F.zip_with(codes, F.slice(codes, F.lit(2), F.length(candidate)), lambda a, b: F.when(b.isNotNull(), _byte(surprise, a * 27 + b)).otherwise(0))
    out = {
        "length": F.length(candidate),
        "digits": _share(candidate, "[0-9]"),
        "uppers": _share(candidate, "[A-Z]"),
        "lowers": _share(candidate, "[a-z]"),
        "transitions": (F.length(classes) - 1) / n,
        "distinct": F.size(F.array_distinct(F.split(candidate, ""))) / n,
        "unlikely": F.aggregate(steps, F.lit(0), lambda acc, x: acc + x) / n,
        "dictionary": F.greatest(known, _share(low, words)),
        "hex": candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "prefix": candidate.rlike(PREFIX),
        "repeats": _share(candidate, r"(.)\1{2,}"),
        "separators": _share(candidate, "[_./-]"),
        "assigned": before.rlike(r"[:=]\s*[\"'`]?$"),
        "quoted": before.rlike("[\"'`]$") & after.rlike("^[\"'`]"),
        "beside": near.rlike(BESIDE),
        "beside_other": near.rlike(BESIDE_OTHER),
        "test_path": path.rlike(TEST_PATH),
    }
    return [F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"f_{k}") for k, c in out.items()]


def labelled_findings(spark: SparkSession, n: int = 4000, part: str = "train") -> DataFrame:
    """candidate, before, after, path, label: findings of known kinds, made by rule; about half are secrets.

    The parts train and held have other ids and, but for what only words and characters
    tell, other forms: names, signs, prefixes and paths.
    """
    held = part == "held"
    own = F.concat(F.lit(part), F.col("id").cast("string"))
    h, g = F.sha2(F.concat(F.lit("a"), own), 256), F.sha2(F.concat(F.lit("b"), own), 256)
    b64 = F.base64(F.unhex(h))
    alnum = F.translate(b64, "+/=", "xyz")
    at = lambda salt, k: (F.pmod(F.xxhash64(own, F.lit(salt)), F.lit(k)) + 1).cast("int")
    words = WORDS[1::2] if held else WORDS[::2]
    word = lambda k: F.element_at(F.array(*map(F.lit, words)), at(f"word{k}", len(words)))
    three = [word(k) for k in range(4)]
    pick = lambda salt, *c: F.element_at(F.array(*(x if isinstance(x, Column) else F.lit(x) for x in c)), at(salt, len(c)))
    hexed = pick("hex", F.substring(h, 1, 40), F.substring(h, 1, 32), h, F.upper(F.substring(h, 1, 40)), F.substring(h, 1, 24), F.substring(h, 1, 48))
    mark = pick("mark", "!", "#", "%", "?", "*", "")
    short = pick("short", F.substring(alnum, 1, 8), F.concat(F.substring(alnum, 1, 6), mark, F.substring(alnum, 7, 4)), F.concat(F.initcap(word(5)), F.conv(F.substring(h, 1, 3), 16, 10), mark, F.substring(alnum, 3, 3)), F.concat(word(5), F.substring(alnum, 5, 5)), F.substring(alnum, 9, 14))
    if held:
        branded = [F.concat(F.lit("gho_"), F.substring(alnum, 1, 36)), F.concat(F.lit("ASIA"), F.substring(F.upper(alnum), 1, 16)), F.concat(F.lit("glpat-"), F.substring(alnum, 1, 20)), F.concat(F.lit("npm_"), F.substring(alnum, 1, 36))]
        signs = ['"passwd": "', "DB_PASSWORD=", "secret => '", "clientSecret = \"", "X-Auth-Token: ", "postgres://admin:", "API_KEY=", "credentials: \""]
        plain = ["sha1 ", "build ", "guid=", "Etag: ", "from ", "isbn ", "file ", "use ", "release "]
        paths, tests = ["lib/core.go", "conf/prod.toml", "run.sh", "site"], "examples/"
    else:
        branded = [F.concat(F.lit("ghp_"), F.substring(alnum, 1, 36)), F.concat(F.lit("AKIA"), F.substring(F.upper(alnum), 1, 16)), F.concat(F.lit("sk_live_"), F.substring(alnum, 1, 24)), F.concat(F.lit("eyJ"), b64, F.lit("."), F.base64(F.unhex(g)))]
        signs = ['token = "', "api_key: ", 'secret="', "password = '", "Authorization: Bearer ", "auth_token=", 'TOKEN = "', "access_key = \"", "client_secret: '", "API_TOKEN=", "mysql://root:", "pwd: "]
        plain = ["commit ", "sha256:", "md5 checksum ", "id=", "uuid: ", "etag=\"", "digest ", "revision ", "see ", "in ", "the ", "path = \"", "import "]
        paths, tests = ["src/main.py", "app/config.yml", "deploy/env", "src7", "server/settings.json", "web"], "tests/fixtures/"
    secret = pick("secret", hexed, hexed, alnum, b64, *branded, short, short, short)
    other = pick(
        "not", hexed, h, F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), F.concat_ws("_", *three), F.concat_ws("-", *three), F.concat(*map(F.initcap, three)), F.concat_ws("/", *three),
        F.concat(F.translate(F.substring(h, 1, 16), "abcdef", "123456")), F.concat(*three), F.concat_ws(".", *three),
    )
    empty = pick("empty", "xxxxxxxxxxxxxxxxxxxxxxxx", "your_api_key_here", "0000000000000000000000", "changeme_changeme_changeme", "EXAMPLE_TOKEN_VALUE", "test_secret_placeholder", "AAAAAAAAAAAAAAAAAAAAAAAA", F.concat_ws("_", *three), F.concat(F.lit("example"), F.initcap(three[0]), F.initcap(three[1])), F.concat(F.lit("$"), three[0], three[1]), "1234567890123456", "********", "changeme", "password", "required", word(6), F.concat(word(6), word(7)), F.concat_ws(".", word(6), word(7)), F.concat(F.lit("get"), F.initcap(word(6))))
    rows = spark.range(n).withColumn("kind", F.col("id") % 4)
    positive, decoy = F.col("kind") < 2, F.col("kind") == 2
    tested = (F.col("kind") == 3) & (F.col("id") % 20 == 3)
    candidate = F.when(positive | tested, secret).when(decoy, empty).otherwise(other)
    filler = F.concat(word(8), F.lit(" "), word(9), F.lit(" "))
    before = F.concat(filler, F.when(positive | decoy | tested, pick("sign", *signs)).otherwise(pick("plain", *plain)))
    after = F.when(before.rlike("[\"']$"), F.substring(before, -1, 1)).when(before.rlike("://"), F.lit("@")).otherwise(F.lit(" "))
    return rows.select(candidate.alias("candidate"), before.alias("before"), after.alias("after"), F.when(tested, F.concat(F.lit(tests), three[0])).otherwise(pick("path", *paths)).alias("path"), positive.cast("double").alias("label"))


class SecretModel:
    """A forest with the language its features come from."""

    def __init__(self, forest: RandomForestClassificationModel, language: Language, bits: bytes | bytearray):
        self.forest, self.language, self.bits = forest, language, bits

    def scored(self, rows: DataFrame) -> DataFrame:
        """rows with candidate, before, after, path, and score."""
        text = lambda c: F.coalesce(F.col(c), F.lit(""))
        own = rows.select("*", *features(F.col("candidate"), text("before"), text("after"), text("path"), self.language, self.bits))
        out = self.forest.transform(VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(own))
        return out.select(*rows.columns, F.element_at(vector_to_array("probability"), 2).alias("score"))


def train(findings: DataFrame, language: Language, trees: int = 30, depth: int = 9, seed: int = 7) -> SecretModel:
    """A forest from labelled findings; rows with a null label or candidate are left out."""
    bits = language.bits(findings.sparkSession)
    rows = findings.filter(F.col("label").isNotNull() & F.col("candidate").isNotNull())
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = rows.select(*features(F.col("candidate"), text("before"), text("after"), text("path"), language, bits), F.col("label").cast("double").alias("label"))
    rows = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(rows)
    return SecretModel(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=3).fit(rows.select("features", "label")), language, bits)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """doc_id, start, candidate, before, after, path of each candidate; start counts characters from 0.

    A name, its sign and quotes before a value are no part of the candidate. Long runs of
    letters of one case are candidates only where a name is assigned.
    """
    found = F.regexp_extract_all("__text", F.lit(CANDIDATE), F.lit(0))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"))
    rows = rows.filter(F.col("__text").rlike(CANDIDATE)).select("doc_id", "path", found.alias("found"), F.split("__text", CANDIDATE, -1).alias("gaps"))
    step = F.transform("found", lambda m, i: F.length(F.get("gaps", i)) + F.length(m))
    ends = F.aggregate(step, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.element_at(F.when(F.size(acc) > 0, acc), -1), F.lit(0)) + x)))
    rows = rows.withColumn("ends", ends)
    named = lambda m: F.regexp_extract(m, PREFIX_OF, 0)

    def one(m: Column, i: Column) -> Column:
        own = F.when(m.rlike(rf"^{URL}"), F.regexp_replace(m, "@$", "")).otherwise(m)
        value = F.substr(own, F.length(named(m)) + F.lit(1), F.length(own))
        after = F.concat(F.substr(m, F.length(own) + F.lit(1), F.lit(1)), F.left(F.get("gaps", i + 1), F.lit(16)))
        return F.struct((F.get("ends", i) - F.length(m) + F.length(named(m))).cast("long").alias("start"), value.alias("candidate"), F.concat(F.right(F.get("gaps", i), F.lit(64)), named(m)).alias("before"), after.alias("after"), (named(m) != "").alias("named"))

    mixed = lambda e: e["named"] | e["candidate"].rlike("[0-9]") | e["candidate"].rlike("[a-z].*[A-Z]|[_+/=]")
    return rows.select("doc_id", "path", F.explode(F.filter(F.transform("found", one), mixed)).alias("e")).select("doc_id", "e.start", "e.candidate", "e.before", "e.after", "path")


def scan(docs: DataFrame, model: SecretModel, threshold: float = 0.5) -> DataFrame:
    """Per candidate: doc_id, start, length, sha256 (of the candidate), masked, score, is_secret.

    Null and empty texts have no candidates, a null path is an empty one; repeated rows
    report again; an empty table gives an empty result. The secret itself is not
    returned, only its digest and first four characters.
    """
    p = F.col("score")
    return model.scored(candidates(docs)).select("doc_id", "start", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("sha256"), F.rpad(F.left("candidate", F.lit(4)), 12, "*").alias("masked"), p, (p >= threshold).alias("is_secret"))


def scan_documents(docs: DataFrame) -> DataFrame:
    """scan() with dictionary and letter pairs of all texts and a forest from labelled_findings()."""
    return scan(docs, train(labelled_findings(docs.sparkSession), Language.fit(docs)))
