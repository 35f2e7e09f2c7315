"""File sources: catalogues, exclusion lists, transcripts, logs, damaged JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import title

#: The forms of an address that hold an id, in the order they are tried.
URL_IDS = [r"youtube\.com/watch\?v=([\w-]+)", r"youtu\.be/([\w-]+)", r"/embed/([\w-]+)"]


def url_id(url: Column, patterns: list[str] = URL_IDS) -> Column:
    """The id in a URL by the first pattern that finds one, else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in patterns])


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(entry, url, video_id, year, has_english) of all ``YEAR/ENTRY/video_url.txt`` under path that hold an id.

    has_english: ENTRY has a file under ``english``; found by listing, no such file is read.
    """
    t = spark.read.text(f"{path}/*/*/video_url.txt", wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    parts = F.split("file", "/")
    d = t.select(F.element_at(parts, -2).alias("entry"), F.element_at(parts, -3).try_cast("int").alias("year"), strip(F.col("value")).alias("url"))
    d = d.withColumn("video_id", url_id(F.col("url"))).where("video_id IS NOT NULL")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*").load(path).select(F.split("path", "/").alias("p"))
    english = files.where(F.element_at("p", -2) == "english").select(F.element_at("p", -3).alias("entry"), F.element_at("p", -4).try_cast("int").alias("year"), F.lit(True).alias("has_english")).distinct()
    return d.join(english, ["entry", "year"], "left").select(*d.columns, F.coalesce("has_english", F.lit(False)).alias("has_english"))


def read_mappings(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of files that hold one JSON object of any layout each: a row a key, the value as variant."""
    t = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v")).where("v IS NOT NULL")
    return t.select(F.explode(F.from_json(F.to_json("v"), "map<string,string>")).alias("key", "raw")).select("key", F.coalesce(F.try_parse_json("raw"), F.parse_json(F.to_json(F.struct("raw")))).alias("value"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(entry, transcript, title) of ``ENTRY/english/sentence_timings.json``: arrays of arrays, whose first items are the sentences.

    What is no array is skipped; the title comes from ``title.json`` beside it, else from the entry's name.
    """
    read = lambda name: spark.read.text(f"{path}/*/english/{name}", wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -3).alias("entry"), F.try_parse_json("value").alias("v"))
    sentences = F.transform(F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.try_variant_get(x, "$[0]", "string"))
    t = read("sentence_timings.json").select("entry", F.array_join(F.filter(sentences, lambda x: x.isNotNull()), " ").alias("transcript"))
    titles = spark.createDataFrame([], "entry string, given string")
    if _any_file(spark, f"{path}/*/english/title.json"):
        titles = read("title.json").select("entry", F.try_variant_get("v", "$.input", "string").alias("given"))
    name = title(F.col("entry"))
    return t.join(titles, "entry", "left").select("entry", "transcript", F.coalesce("given", name).alias("title"))


def _any_file(spark: SparkSession, pattern: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_plain_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(entry, transcript) of ``ENTRY/transcript.txt``."""
    t = spark.read.text(f"{path}/*/transcript.txt", wholetext=True)
    return t.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("entry"), strip(F.col("value")).alias("transcript"))


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    """(entry, state, status, confidence, primary_files) of ``ENTRY/matches.json``; damaged files are salvaged where they can be.

    state: valid, salvaged, corrupt or empty; what is lost gets the placeholder status corrupted_recovered.
    """
    t = spark.read.text(f"{path}/*/matches.json", wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("entry"), "value")
    d = t.select("entry", json_state(F.col("value")).alias("state"), salvage_json(F.col("value")).alias("raw"))
    state = F.when((F.col("state") == "corrupt") & F.col("raw").isNotNull(), "salvaged").otherwise(F.col("state"))
    m = d.select("entry", state.alias("state"), normalise_matches(F.col("raw")).alias("m"))
    lost = F.col("state").isin("corrupt", "empty")
    return m.select("entry", "state", F.when(lost, "corrupted_recovered").otherwise(F.col("m.status")).alias("status"), F.when(lost, 0.0).otherwise(F.col("m.confidence")).alias("confidence"), F.when(lost, F.array().cast("array<string>")).otherwise(F.col("m.primary_files")).alias("primary_files"))


def total_sizes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(folder, files, total_size) of the files under path, from the listing alone."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "length")
    return f.groupBy(F.element_at(F.split("path", "/"), -2).alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("total_size"))


def read_symbol_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(module, symbol) and (module, statement) of an index file with maps ``modules`` and ``imports``."""
    v = spark.read.schema("modules map<string,array<string>>, imports map<string,array<string>>").json(path, multiLine=True)
    rows = lambda c, name: v.select(F.explode(c).alias("module", "x")).select("module", F.explode("x").alias(name))
    return rows("modules", "symbol"), rows("imports", "statement")


#: Where a module of a name may lie in an index, in the order tried.
MODULE_PLACES = ["data/videos/{}.py", "data/videos/{}/__init__.py", "data/videos/custom/{}.py", "data/videos/once_useful_constructs/{}.py"]


def resolve_star_imports(imports: DataFrame, index: DataFrame, heuristic: dict[str, list[str]]) -> DataFrame:
    """(key, module, symbol, way) for star imports (key, module): the first place of the index that has the module, else a path
    that ends like it, else the symbols that a part of its name suggests. All are equi-joins."""
    wanted = imports.select("key", "module").distinct()
    modules = index.select(F.col("module").alias("path")).distinct()
    places = F.array(*[F.struct(F.lit(k).alias("rank"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in enumerate(p.split("{}") for p in MODULE_PLACES)])
    tried = wanted.select("module").distinct().withColumn("p", F.explode(places)).select("module", F.col("p.rank").alias("rank"), F.concat("p.a", "module", "p.b").alias("path"))
    parts = F.split("path", "/")
    ends = modules.select("path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))).alias("end"))
    dotted = wanted.select("module").distinct().where(F.contains("module", F.lit("."))).select("module", F.concat(F.replace("module", F.lit("."), F.lit("/")), F.lit(".py")).alias("end"))
    found = tried.join(modules, "path").unionByName(dotted.join(ends, "end").select("module", F.lit(len(MODULE_PLACES)).alias("rank"), "path"))
    best = found.groupBy("module").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))
    by_index = best.join(index.select(F.col("module").alias("path"), "symbol"), "path").select("module", "symbol", F.lit("index").alias("way"))
    hints = [(w, s) for w, symbols in heuristic.items() for s in symbols]
    guess = imports.sparkSession.createDataFrame(hints or [("", "")], "word string, symbol string")
    unknown = wanted.select("module").distinct().join(best, "module", "left_anti")
    words = unknown.select("module", F.explode(F.array(*[F.when(F.contains(F.lower("module"), F.lit(w)), w) for w in heuristic] or [F.lit(None).cast("string")])).alias("word"))
    by_name = words.join(F.broadcast(guess), "word").select("module", "symbol", F.lit("heuristic").alias("way")).distinct()  # a stated table of hints
    return wanted.join(by_index.unionByName(by_name), "module").select("key", "module", "symbol", "way").distinct()


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """(video_id) of the lines that start with "- " and hold an address with an id; headings and blanks are skipped."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).where(F.startswith("line", F.lit("- ")))
    found = F.regexp_extract(F.regexp_extract("line", r"(https?://\S+)", 1), r"[?&]v=([\w-]+)", 1)
    return lines.select(found.alias("video_id")).where("video_id <> ''").distinct()


def parses(raw: Column) -> Column:
    """Whether a text is JSON as a whole; the parser itself would let text after the first value pass."""
    whole = ~raw.rlike(r"^\s*[\{\[]") | raw.rlike(r"[\}\]]\s*$")
    return F.coalesce(F.try_parse_json(raw).isNotNull() & whole, F.lit(False))


def salvage_json(raw: Column) -> Column:
    """The text from the first line that starts with { to the line on which its braces balance, where the whole does not parse.

    Braces are counted line by line, wherever they stand, so an object need not close at the start of a line; null where they
    never balance.
    """
    lines = F.split(raw, "\n")
    first = F.array_position(F.transform(lines, lambda s: F.startswith(F.trim(s), F.lit("{"))), True)
    net = lambda s: (F.length(s) - F.length(F.replace(s, F.lit("{"), F.lit("")))) - (F.length(s) - F.length(F.replace(s, F.lit("}"), F.lit(""))))
    rest = F.slice(lines, F.greatest(first, F.lit(1)).cast("int"), F.size(lines))
    # state: text so far, open braces, done
    start = F.struct(F.lit("").alias("t"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(a: Column, s: Column) -> Column:
        text = F.when(a["t"] == "", s).otherwise(F.concat(a["t"], F.lit("\n"), s))
        now = a["n"] + net(s)
        return F.struct(F.when(a["done"], a["t"]).otherwise(text).alias("t"), F.when(a["done"], a["n"]).otherwise(now).alias("n"), (a["done"] | (now <= 0)).alias("done"))

    cut = F.aggregate(rest, start, step, lambda a: F.when(a["done"], a["t"]))
    return F.when(parses(raw), raw).when((first > 0) & parses(cut), cut)


def json_state(raw: Column) -> Column:
    """empty, valid or corrupt."""
    return F.when(F.trim(F.coalesce(raw, F.lit(""))) == "", "empty").when(parses(raw), "valid").otherwise("corrupt")


def read_logs(spark: SparkSession, new: str, old: str, key: str) -> DataFrame:
    """Logs of two places, one JSON object a line: the new place wins, key by key of the columns."""
    a, b = spark.read.json(new), spark.read.json(old)
    names = list(dict.fromkeys([*a.columns, *b.columns]))
    joined = a.alias("a").join(b.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    pick = lambda c: F.coalesce(*[F.col(f"{t}.{c}") for t, d in (("a", a), ("b", b)) if c in d.columns]).alias(c)
    return joined.select(*map(pick, names))


def normalise_matches(raw: Column) -> DataFrame | Column:
    """struct<status, confidence, primary_files> of a match record in either of its layouts."""
    v = F.try_parse_json(raw)
    get = lambda path, kind: F.coalesce(F.try_variant_get(v, f"$.match_data.{path}", kind), F.try_variant_get(v, f"$.{path}", kind))
    status = F.coalesce(F.try_variant_get(v, "$.process_status", "string"), F.try_variant_get(v, "$.status", "string"))
    files = F.coalesce(get("primary_files", "array<string>"), F.array().cast("array<string>"))
    return F.struct(status.alias("status"), F.coalesce(get("confidence_score", "double"), F.lit(0.0)).alias("confidence"), files.alias("primary_files"))
