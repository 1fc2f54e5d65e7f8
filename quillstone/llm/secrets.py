"""Secret scans: candidates by pattern, false positives removed by a random forest, in DataFrame functions only."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

_PEM = r"-----BEGIN [A-Z ]{0,40}?PRIVATE KEY-----[^-]++(?:-[^-]++){0,8}?-----END [A-Z ]{0,40}?PRIVATE KEY-----"
_USER = r"(?<=:)(?<=://[A-Za-z0-9._%+\-]{1,64}:)[^\s/@:\"'<>]{3,}+(?=@)"
_QUOTED = r"(?<=[\"'`])(?<=[=:][ \t]{0,2}[\"'`])[^\s\"'`]{4,}+(?=[\"'`])"
_VALUE = r"[^\s\"'`<>,;()\[\]{}&]"
#: A bracket inside a password: between characters of which one is no letter, as in a call it is not.
_INNER = r"(?:(?<=[0-9!@#$%^*+=?~|])[()\[\]{}]|[()\[\]{}](?=[0-9!@#$%^*+=?~|]))"
_PLAIN = rf"(?<=[=: \t])(?<=[A-Za-z0-9_\-\"'\])][ \t]?[=:][ \t]{{0,2}})(?<![0-9]:)(?![/\"'`])(?={_VALUE}{{5}})(?=[A-Za-z]*+[^A-Za-z\s,;.?!])(?:{_VALUE}+(?:(?:&(?![A-Za-z0-9_]{{1,32}}=)|{_INNER}){_VALUE}+){{0,16}})(?<![.:])"
_RUN = r"(?<![A-Za-z0-9+/_.\-])(?=[A-Za-z+/_.\-]*+[0-9]|[A-Za-z+/_.\-]{20})[A-Za-z0-9+/_.\-]{7,}[A-Za-z0-9+/_]=*+"
#: A candidate: a private key block, the password of a URL, a quoted or a plain value after '=' or ':' of any alphabet,
#: or a run of at least 8 characters with a digit or 20 without. Names and signs before it are context.
CANDIDATE = "|".join([_PEM, _USER, _QUOTED, _PLAIN, _RUN])
#: Keys that show by their beginning what they are.
PREFIXED = "^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abp]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,})$"
REDACTED = "[SECRET]"
#: Characters of context before and after a candidate.
CONTEXT = 32
#: Texts of labelled findings that the transitions and the forest are fitted on, at most.
FINDINGS = 8000
TREES, DEPTH, SEED = 24, 8, 8
SECRET_WORDS = "token|secret|passw|pwd|api[_-]?key|apikey|auth|credential|bearer|private|access[_-]?key"
HARMLESS_WORDS = "commit|sha1|sha256|md5|digest|checksum|hash|uuid|guid|etag|revision|version|build|isbn|doi|page|file|url|href|order|invoice|phone"
#: Common words and parts of names; ``Forest`` takes other ones.
DICTIONARY = (
    "about access account action active address admin after all and any api app archive array article auth backup base before body book buffer build business cache call card case change chapter check "
    "class client cloud code column command comment company config connect content context copy count country create current customer data database date debug default delete detail device directory disabled "
    "display document domain edit email enabled end error event example export false field figure file filter first for format from function general group handler header help home host html http image import "
    "index info input install item job json key label language last level library line link list load local location login main manager map message method mode model module month name net new next not null "
    "number object only option order output package page part password path pattern plan port print product profile project public query random read record report request response result role root route "
    "safe schema search secret section select server service session shop source stage start state storage string system table target test text time title token total true type unit update upload user "
    "value version view web week window word work world year zone"
).split()
_SYMBOLS = "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the letter transitions: 26 letters, digit, other; and of the shape transitions: lower, upper, digit, other.
LETTERS, SHAPES = 28, 4
SHAPE_FLAGS = {
    "hex": "^([0-9a-f]+|[0-9A-F]+)$",
    "uuid": "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    "numeric": "^[0-9.,:/TZ+-]+$",
    "placeholder": "(?i)^(your|my|some|change|example|dummy|redacted|insert)|xxx|\\*\\*\\*|\\.\\.\\.|[$%]\\{|^\\$",
    "prefixed": PREFIXED,
    "block": "^-----BEGIN",
}
PATH_FLAGS = {"test_path": "test|fixture|example|sample|mock", "settings_path": "\\.(env|ya?ml|ini|cfg|conf|toml|properties|json)$|settings|config", "text_path": "\\.(md|rst|txt|html?)$|readme|docs?/"}
FEATURES = ["length", "digits", "uppers", "others", "different", "letter_odds", "shape_odds", "coverage", "separators", *SHAPE_FLAGS, *PATH_FLAGS, "secret_name", "harmless_name", "secret_near", "harmless_near", "assigned", "quoted", "in_url", "names"]


def _table(values: list) -> Column:
    """Array of numbers or strings, all of one type, written as one string: a plan of few nodes, which the optimizer folds to a literal."""
    kind = {int: "int", float: "double", str: "string"}[type(values[0])]
    return F.split(F.lit("\x1f".join(map(str, values))), "\x1f").cast(f"array<{kind}>")


def _letters(word: Column) -> Column:
    """Symbols of a word's characters for the letter transitions."""
    of = [26 if 48 <= k < 58 else (k | 32) - 97 if chr(k).isascii() and chr(k).isalpha() else 27 for k in range(128)]
    return F.transform(F.split(word, ""), lambda x: F.coalesce(F.get(_table(of), F.ascii(x)), F.lit(27)))


def _shapes(word: Column) -> Column:
    of = [2 if 48 <= k < 58 else 0 if 97 <= k < 123 else 1 if 65 <= k < 91 else 3 for k in range(128)]
    return F.transform(F.split(word, ""), lambda x: F.coalesce(F.get(_table(of), F.ascii(x)), F.lit(3)))


def _steps(symbols: Column, n: int) -> Column:
    """Number of each transition of an array of symbols."""
    return F.zip_with(F.slice(symbols, 1, F.greatest(F.size(symbols) - 1, F.lit(0))), F.slice(symbols, 2, F.greatest(F.size(symbols) - 1, F.lit(0))), lambda a, b: a * n + b)


def _odds(symbols: Column, n: int, odds: list[float]) -> Column:
    """Mean log odds of a word's transitions."""
    total = F.aggregate(_steps(symbols, n), F.lit(0.0), lambda s, x: s + F.get(_table(odds), x))
    return total / F.greatest(F.size(symbols) - 1, F.lit(1))


def _parts_of(name: Column) -> Column:
    """Letter runs of a name, also parted where lower case turns into upper case."""
    return F.regexp_extract_all(name, F.lit("[A-Z]?[a-z]+|[A-Z]+"), 0)


def features(word: Column, before: Column, after: Column, path: Column, letter_odds: list[float], shape_odds: list[float], words: list[str]) -> Column:
    """Struct of FEATURES, doubles: of the candidate, its character transitions, the dictionary's share, path and neighbours."""
    n = F.greatest(F.length(word), F.lit(1)).cast("double")
    share = lambda pattern: F.length(F.regexp_replace(word, pattern, "")) / n
    flag = lambda x: F.when(x, 1.0).otherwise(0.0)
    near, at = F.lower(F.concat(before, F.lit(" "), after)), F.lower(before)
    known = F.aggregate(F.filter(_parts_of(word), lambda x: F.lower(x).isin(words)), F.lit(0), lambda s, x: s + F.length(x))
    values = {
        "length": F.log2(n), "digits": share("[^0-9]"), "uppers": share("[^A-Z]"), "others": share("[A-Za-z0-9]"),
        "different": F.size(F.array_distinct(F.split(word, ""))) / F.least(n, F.lit(64.0)),
        "letter_odds": _odds(_letters(word), LETTERS, letter_odds), "shape_odds": _odds(_shapes(word), SHAPES, shape_odds),
        "coverage": known / n, "separators": share("[^./_-]"),
        **{k: flag(word.rlike(p)) for k, p in SHAPE_FLAGS.items()}, **{k: flag(F.lower(path).rlike(p)) for k, p in PATH_FLAGS.items()},
        "harmless_name": flag(at.rlike(f"({HARMLESS_WORDS})[a-z0-9_-]*[\"']?(\\s*[=:]\\s*|\\s+)[\"'`]?$")),
        "secret_name": flag(at.rlike(f"({SECRET_WORDS})[a-z0-9_-]*[\"']?(\\s*[=:]\\s*|\\s+(is\\s+)?)[\"'`]?$")), "secret_near": flag(near.rlike(SECRET_WORDS)), "harmless_near": flag(near.rlike(HARMLESS_WORDS)),
        "assigned": flag(before.rlike("[=:]\\s*[\"'`]?$")), "quoted": flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "in_url": flag(before.rlike("://[^\\s:@/]+:$") & after.startswith("@")), "names": flag(after.rlike("^[\"']?\\s*[=:(]")),
    }
    return F.struct(*[values[k].cast("double").alias(k) for k in FEATURES])


def example_texts(spark: SparkSession, n: int = FINDINGS, first: int = 0) -> DataFrame:
    """Texts (text, value, path, label) with one labelled value each, made by a fixed rule from row numbers.

    Kind of value, words before it and path are drawn apart, so that no word and no form decides alone. Hexadecimal
    keys, passwords and strings with symbols stand after names such as ``token =``, mixed-case keys and random letters also in bare
    prose and prefixed keys, key blocks and URL passwords anywhere. Harmless are UUIDs, file names, dates, versions,
    addresses, numbers, placeholders, identifiers, compounds and words, after the same names and in the same prose; digests after
    words such as ``commit`` and in prose; and keys and passwords after a secret's name in files of tests.
    """
    c, lit = F.col, F.lit
    at = lambda salt, n: (1 + F.pmod(F.xxhash64("id", lit(salt)), lit(n))).cast("int")
    pick = lambda salt, *xs: F.element_at(F.array(*[x if isinstance(x, Column) else lit(x) for x in xs]) if any(isinstance(x, Column) for x in xs) else _table(xs), at(salt, len(xs)))
    number = lambda salt, below: F.pmod(F.xxhash64("id", lit(salt)), lit(below)).cast("string")
    syllables = "an be cor de el fi gra ho in ju kel lo mer no or pe qui ra so ti ur ve wa yo the ing tion ment ness ver ein ung keit heit lich schaft ach eau aire oux ette ci\u00f3n dad mente os ble er st th ch".split()
    odd = lambda salt, n=3: F.concat(*[pick(f"{salt}{k}", *syllables) for k in range(n)])
    word = lambda salt: F.when(F.pmod(F.xxhash64("id", lit(salt)), lit(3)) == 0, pick(f"d{salt}", *DICTIONARY[::3])).otherwise(odd(salt))
    cut = lambda x, *sizes: F.substr(x, lit(1), pick("size", *sizes))
    h = F.sha2(F.concat(lit("finding"), c("id").cast("string")).cast("binary"), 512)
    mixed = F.translate(F.base64(F.unhex(h)), "=\n", "xQ")
    plain = F.translate(mixed, "+/", "pZ")
    leet = F.translate(word("leet"), "aeio", "4310")
    password = F.concat(pick("pw", F.initcap(word("pw")), word("pw"), leet, F.concat(leet, word("pw"))), pick("pq", number("pn", 10), number("pn", 100), number("pn", 10_000)), pick("ps", "!", "#", "$", "&", "@", "", "?x"))
    block = F.concat(lit("-----BEGIN RSA PRIVATE KEY-----\n"), F.substring(mixed, 1, 64), lit("\n"), F.substring(mixed, 9, 64), lit("\n-----END RSA PRIVATE KEY-----"))
    secrets = {
        "hex": cut(h, 32, 40, 48, 64), "mixed": cut(mixed, 20, 24, 32, 40, 64), "upper": F.upper(cut(h, 32, 40)), "letters": F.substring(F.regexp_replace(mixed, "[^A-Za-z]", ""), 1, 36), "password": password, "symbols": F.concat(word("s1"), lit("-"), word("s2"), lit("-"), F.translate(cut(plain, 16, 24, 32), "aeiouAEIOUst", "!@#$%^*=+~()")), "block": block, "user": password,
        "prefixed": pick("px", F.concat(lit("AKIA"), F.upper(F.substring(plain, 1, 16))), F.concat(lit("ghp_"), F.substring(plain, 1, 36)), F.concat(lit("xoxb-"), number("x1", 1 << 30), lit("-"), F.substring(plain, 1, 24)), F.concat(lit("sk_live_"), F.substring(plain, 1, 24))),
    }
    harmless = {
        "uuid": F.regexp_replace(F.substring(h, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), "digest": cut(h, 40, 64, 32),
        "file": F.concat(word("f1"), pick("f", "-", "_", "/"), number("f", 400), pick("f2", "_section_", "/", "-", "_"), word("f3"), pick("f4", ".png", ".txt", ".py", ".html", "")),
        "date": F.concat(number("y", 90), lit("20-0"), number("m", 9), lit("-1"), number("d", 9), pick("t", "", "T10.00.00", "T08:15:00Z")), "version": F.concat(pick("v", "v", "", "version-", "release-"), number("v1", 20), lit("."), number("v2", 40), lit("."), number("v3", 99), pick("v4", "-release", "", "-rc1")),
        "address": F.concat(pick("w", "www.", "mail" , "http//", ""), word("a1"), number("a", 99), pick("w2", ".com/", ".example.org/", ".net/data/"), word("a2")),
        "number": pick("n", F.concat(number("n1", 10**9), number("n2", 10**9)), F.concat(lit("+1-555-"), number("n1", 900), lit("-"), number("n2", 9000)), F.concat(number("n1", 200), lit("."), number("n2", 200), lit(".10."), number("n3", 200))),
        "placeholder": pick("pl", "changeme", "your-token-here", "xxxxxxxxxxxxxxxx", "${TOKEN}", "example_key_1", "<password>", "********", "YOUR_API_KEY_123", "dummy1234"),
        "identifier": pick("i", F.concat(word("i1"), F.initcap(word("i2")), F.initcap(word("i3"))), F.concat_ws("_", word("i1"), word("i2"), word("i3"), number("i", 9)), F.upper(F.concat_ws("_", word("i1"), word("i2"), word("i3")))),
        "compound": F.concat(pick("c", odd("c", 5), odd("c", 6), odd("c", 7), F.initcap(odd("c", 6)), odd("c", 4)), pick("cn", "", "", F.concat(lit("."), number("cn", 100)), number("cn", 100))),
        "word": pick("wd", word("wd"), F.initcap(word("wd")), F.concat_ws("-", word("wd"), word("we"))),
    }
    name = ['token = "', 'api_key: "', "secret=", 'password = "', "Authorization: Bearer ", 'ACCESS_KEY="', 'TOKEN = "', "auth_token: '", "passwd: ", "pwd=", "https://api.host.org/get?api_key=", "password: ", "the password is ", "API_KEY=", "client_secret: "]
    told = ["commit ", "sha256: ", 'checksum = "', "see file ", "order ", "revision ", 'version = "', "url: ", 'etag: "', "md5=", "build "]
    prose = ["the ", "and then ", "we saw ", "with ", "", "value ", "it was ", 'x = "', "item: ", "key ", "id="]
    user = ["postgres://admin:", "https://user:", "amqp://svc:"]
    where = {
        "hex": [name], "symbols": [name], "mixed": [name, prose], "upper": [name, prose], "letters": [name, prose], "password": [name], "block": [prose, name, told], "user": [user], "prefixed": [name, told, prose],
        "uuid": [told, prose], "digest": [told, told, prose], "file": [name, told, prose], "date": [name, told, prose], "version": [name, told, prose], "address": [name, told, prose], "number": [name, told, prose], "placeholder": [name, name, prose], "identifier": [name, told, prose], "compound": [told, prose, prose, prose], "word": [name, told, prose],
    }
    place = lambda k: pick(f"g{k}", *[pick(f"l{j}", *g) for j, g in enumerate(where[k])])
    one = lambda k, v, y: F.struct(v.alias("value"), place(k).alias("lead"), lit(y).alias("label"), lit(k in ("password", "hex", "mixed")).alias("fixture"))
    path = pick("path", "src0", "src7", "", "docs/readme.md", "tests/fixture.json", "test_login.py", "samples/mock_data.py", "app/settings.yaml", "web.conf", "lib/client.py").alias("path")
    kinds = spark.range(first, first + n, 1, 1).select("id", pick("kind", *[*secrets] * 5, *[*harmless] * 4).alias("kind"))
    made = [kinds.filter(c("kind") == k).select("id", one(k, v, float(k in secrets)).alias("x"), path) for k, v in (secrets | harmless).items()]
    rows = written(reduce(DataFrame.unionByName, made), "examples")  # a small plan for each kind of value
    quoted = F.regexp_extract("x.lead", "[\"']$", 0)
    after = F.when(c("x.lead").contains("://") & c("x.lead").endswith(":"), lit("@host.org/db")).otherwise(F.concat(quoted, pick("z", " and more words", ".", "\n", ", then others", " here", ". See commit", " in the file", " by token", " or build")))
    mock = c("x.fixture") & F.lower("path").rlike(PATH_FLAGS["test_path"]) & c("x.lead").isin(name)
    text = F.concat(word("b1"), lit(" "), word("b2"), pick("b", " ", ". ", "\n"), "x.lead", "x.value", after, lit(" "), word("b3"))
    return rows.select("id", text.alias("text"), c("x.value").alias("value"), "path", F.when(mock, 0.0).otherwise(c("x.label")).alias("label"))


def _cut(text: Column) -> Column:
    """Array of (word, before, after, gap) of a text: its candidates, their context and the text from the previous one; last what follows."""
    whole = F.coalesce(text, F.lit(""))
    found, gaps = F.regexp_extract_all(whole, F.lit(f"({CANDIDATE})"), 0), F.split(whole, CANDIDATE, -1)
    return F.struct(found.alias("found"), gaps.alias("gaps"))


def findings(texts: DataFrame, path: Column) -> DataFrame:
    """The texts' columns and (word, before, after, __path), a row for each candidate."""
    cut = texts.withColumn("__cut", _cut(F.col("text"))).withColumn("__path", F.coalesce(path, F.lit("")))
    return cut.select("*", F.posexplode("__cut.found").alias("__at", "word")).select(
        *texts.columns, "word", F.substring(F.get("__cut.gaps", F.col("__at")), -CONTEXT, CONTEXT).alias("before"), F.substring(F.get("__cut.gaps", F.col("__at") + 1), 1, CONTEXT).alias("after"), "__path"
    )


def labelled(texts: DataFrame) -> DataFrame:
    """Labelled findings by the scan's own extraction: a candidate that is no part of the labelled value is harmless."""
    hit = F.coalesce((F.col("word") == F.col("value")) | F.col("word").contains(F.col("value")) | F.col("value").contains(F.col("word")), F.lit(False))
    return findings(texts, F.col("path")).withColumn("label", F.when(hit, F.col("label")).otherwise(0.0))


class Forest:
    """A fitted forest as an expression over a struct of FEATURES.

    ``texts`` (text, value, path, label) are cut by the scan; of the findings, at most ``bound``, those
    with an even hash give the two transition tables, the others the trees. ``words`` are the dictionary.
    """

    def __init__(self, texts: DataFrame, bound: int = FINDINGS, words: list[str] = DICTIONARY) -> None:
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler

        self.words = sorted(words)
        found = labelled(texts.orderBy(F.xxhash64("text", "value")).limit(bound)).repartition(1).cache()
        even = F.pmod(F.xxhash64("word", "before"), F.lit(2)) == 0
        self.letter_odds, self.shape_odds = (self._odds(found.filter(even), symbols, n) for symbols, n in ((_letters, LETTERS), (_shapes, SHAPES)))
        rows = found.filter(~even).select(self.features("word", "before", "after", "__path").alias("f"), "label").select("f.*", "label")
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label")
        model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(ready)
        found.unpersist()
        self.roots = [self._node(t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode")) for t in model.trees]

    @staticmethod
    def _odds(found: DataFrame, symbols, n: int) -> list[float]:
        """Log odds of each of n * n transitions in secrets against harmless words, with one added to each count."""
        counts = found.select("label", F.explode(_steps(symbols(F.col("word")), n)).alias("step")).groupBy("label", "step").count().collect()
        of = {(r[0], r[1]): r[2] for r in counts}
        total = {y: sum(v for (label, _), v in of.items() if label == y) + n * n for y in (0.0, 1.0)}
        return [round(math.log((of.get((1.0, s), 0) + 1) / total[1.0]) - math.log((of.get((0.0, s), 0) + 1) / total[0.0]), 6) for s in range(n * n)]

    def features(self, word, before, after, path) -> Column:
        col = lambda x: F.col(x) if isinstance(x, str) else x
        return features(col(word), col(before), col(after), col(path), self.letter_odds, self.shape_odds, self.words)

    def _node(self, node):
        if node.numDescendants() == 0:
            stats = list(node.impurityStats().stats())
            return round(float(stats[1] / sum(stats)), 9) if len(stats) > 1 and sum(stats) else 0.0
        split = node.split()
        return FEATURES[split.featureIndex()], float(split.threshold()), self._node(node.leftChild()), self._node(node.rightChild())

    def probability(self, f: str) -> str:
        """SQL of the mean over the trees, of the struct that ``f`` names."""

        def tree(t) -> str:
            return f"{t!r}D" if isinstance(t, float) else f"CASE WHEN {f}.{t[0]} <= {t[1]!r}D THEN {tree(t[2])} ELSE {tree(t[3])} END"

        return f"round(({' + '.join(map(tree, self.roots))}) / {len(self.roots)}, 9)"


_fitted: dict[str, Forest] = {}


def fitted(spark: SparkSession) -> Forest:
    """The forest of ``example_texts``, fitted once in an application: the texts do not hang on any input."""
    key = spark.sparkContext.applicationId
    if key not in _fitted:
        _fitted[key] = Forest(example_texts(spark))
    return _fitted[key]


def _scored(cut: DataFrame, forest: Forest) -> DataFrame:
    """Adds __p, the probabilities of the candidates in __cut."""
    found, gaps, path = F.col("__cut.found"), F.col("__cut.gaps"), F.col("__path")
    each = F.transform(found, lambda x, i: forest.features(x, F.substring(F.get(gaps, i), -CONTEXT, CONTEXT), F.substring(F.get(gaps, i + 1), 1, CONTEXT), path))
    return cut.withColumn("__f", each).withColumn("__p", F.expr(f"transform(__f, f -> {forest.probability('f')})")).drop("__f")


def _starts(lengths: Column) -> Column:
    """Sums of the lengths before each; by runs of 256, since an array that grows is copied at each step."""
    running = lambda xs: F.aggregate(xs, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("all")), lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")))["all"]
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / 256).cast("int")), lambda k: F.slice(lengths, k * 256 + 1, 256))
    sums = F.transform(runs, lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + x))
    return F.flatten(F.zip_with(running(sums), runs, lambda base, xs: F.transform(running(xs), lambda x: base + x)))


def _path(path_col: str | None) -> Column:
    return F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")


def scan(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: id, start (characters before it), length, secret_sha256, probability, is_secret.

    Null and empty texts have no candidates; a null path is an empty one; null identifiers pass through;
    repeated rows give repeated findings; an empty table gives none. Other columns are not read. Whole
    texts are cut at their candidates, without joins or shuffles, in time linear in the candidates.
    """
    cut = docs.select(F.col(id_col), _path(path_col).alias("__path"), _cut(F.col(text_col)).alias("__cut"))
    lengths = F.zip_with("__cut.gaps", "__cut.found", lambda g, x: (F.length(g) + F.coalesce(F.length(x), F.lit(0))).cast("long"))
    found = _scored(cut, forest).withColumn("__starts", _starts(lengths))
    rows = F.zip_with(F.zip_with("__cut.found", "__p", lambda x, p: F.struct(x.alias("x"), p.alias("p"))), F.zip_with("__starts", "__cut.gaps", lambda s, g: s + F.length(g)), lambda a, s: F.struct(a["x"].alias("x"), a["p"].alias("p"), s.alias("s")))
    each = found.select(id_col, F.explode(F.filter(rows, lambda r: r["x"].isNotNull())).alias("r"))
    return each.select(id_col, F.col("r.s").alias("start"), F.length("r.x").cast("long").alias("length"), F.sha2(F.col("r.x").cast("binary"), 256).alias("secret_sha256"), F.col("r.p").alias("probability"), (F.col("r.p") > 0.5).alias("is_secret"))


def redact(docs: DataFrame, forest: Forest, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """The same rows and columns, with each secret in the text replaced; texts without one, and nulls, are untouched."""
    cut = _scored(docs.withColumns({"__path": _path(path_col), "__cut": _cut(F.col(text_col))}), forest)
    new = F.zip_with("__cut.found", "__p", lambda x, p: F.when(p > 0.5, F.lit(REDACTED)).otherwise(x))
    clean = F.array_join(F.zip_with("__cut.gaps", new, lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")
    return cut.withColumn(text_col, F.when(F.exists("__p", lambda p: p > 0.5), clean).otherwise(F.col(text_col))).select(*docs.columns)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), fitted(spark))
