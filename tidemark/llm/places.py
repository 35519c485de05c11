"""Freely typed places to the entries of a reference list: token repair, then soft TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import checkpoint

# Other names of countries than a list of places gives, by ISO code.
COUNTRY_NAMES = {
    "KE": "ke,ken,kenya,kenia,republic of kenya,rep of kenya", "US": "us,usa,united states,united states of america,america,u s,u s a,estados unidos",
    "GB": "gb,gbr,uk,united kingdom,great britain,britain,england,scotland,wales,u k", "DE": "de,deu,ger,germany,deutschland,allemagne,alemania",
    "FR": "fr,fra,france,frankreich,francia", "ES": "es,esp,spain,espana,spanien,espagne", "PT": "pt,prt,portugal,portogallo",
    "NL": "nl,nld,netherlands,nederland,holland,pays bas,niederlande", "PL": "pl,pol,poland,polska,polen,pologne", "IE": "ie,irl,ireland,eire,republic of ireland,rep of ireland,irland,irlande",
    "CA": "ca,can,canada,kanada", "AU": "au,aus,australia,oz,australien", "IN": "in,ind,india,bharat,indien,inde", "BR": "br,bra,brazil,brasil,brasilien,bresil",
    "NG": "ng,nga,nigeria,naija", "UG": "ug,uga,uganda,ouganda",
}
# Words around a place that aren't part of its name.
NOISE = "near downtown greater metro metropolitan area city cbd central centre center office offices hq headquarters remote hybrid onsite on site fully based home from work the of around region inner wfh only".split()
# Letters and what they are without their marks.
MARKED, PLAIN = "àáâãäåāăąçćčďđèéêëēėęěìíîïīįıłľñńňòóôõöøōőřŕśšşťțùúûüūůűýÿźżž", "aaaaaaaaacccddeeeeeeeeiiiiiiillnnnooooooooorrssstttuuuuuuuyyzzz"
ABBREVIATIONS = {"st": "saint", "ste": "sainte", "sta": "santa", "mt": "mount", "ft": "fort", "pt": "port"}
MIN_REPAIRED, MIN_TWO_EDITS, THRESHOLD = 4, 9, 0.72


def country_aliases() -> list[tuple[str, str]]:
    """(alias, code), the aliases without the words that `segments` leaves out."""
    bare = lambda name: " ".join(w for w in name.split() if w not in NOISE)
    return sorted({(bare(name), code) for code, names in COUNTRY_NAMES.items() for name in names.split(",")})


def fold(text: Column) -> Column:
    """Lower case without marks on letters."""
    return F.regexp_replace(F.translate(F.lower(F.regexp_replace(text, r"\p{M}+", "")), MARKED, PLAIN), "ß", "ss")


def two_letters(name: str) -> Column:
    """A name as it is typed without umlauts: ä as ae, ö as oe, ü as ue."""
    out = F.col(name)
    for mark, pair in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")):
        out = F.replace(out, F.lit(mark), F.lit(pair))
    return out


def deletes(word: Column, two: Column | None = None) -> Column:
    """The word and what is left of it without any one letter (any two, where `two` holds)."""
    cut = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
    once = F.concat(F.array(word), F.when(F.length(word) > 0, cut(word)).otherwise(F.array().cast("array<string>")))
    if two is None:
        return F.array_distinct(once)
    return F.array_distinct(F.when(two, F.flatten(F.transform(once, lambda w: F.concat(F.array(w), F.when(F.length(w) > 0, cut(w)).otherwise(F.array().cast("array<string>")))))).otherwise(once))


def edits(a: Column, b: Column) -> Column:
    """Levenshtein distance, but 1 for words that differ only by a letter, or two, in another place."""
    lev = F.levenshtein(a, b)
    letters = lambda w: F.array_sort(F.split(w, ""))
    return F.when((lev == 2) & (F.length(a) == F.length(b)) & (letters(a) == letters(b)), 1).otherwise(lev)


def repair(words: DataFrame, vocabulary: DataFrame, two_edits: bool = True) -> DataFrame:
    """(word, entry, d): each word with the vocabulary's entries at the least distance, at most 2.

    Both have one distinct column, word and entry. Words of fewer than MIN_REPAIRED letters only
    match exactly; two edits are allowed from MIN_TWO_EDITS letters on. The pairs come from an
    equi-join on what is left of either side without some letters, which finds all such pairs.
    Equal ones meet there too, so one join and one grouping by word do for all distances.
    """
    w, e = F.col("word"), F.col("entry")
    # longer words than any entry with two letters more can't be near one
    longest = vocabulary.agg(F.max(F.length("entry"))).first()[0] or 0
    cuts = lambda c: F.when(F.length(c) < MIN_REPAIRED, F.array(c)).otherwise(deletes(c, F.length(c) >= MIN_TWO_EDITS - 1) if two_edits else deletes(c))
    met = words.where(F.length("word") <= longest + 2).select("word", F.explode(cuts(w)).alias("k")).join(vocabulary.select("entry", F.explode(cuts(e)).alias("k")), "k")
    shorter = F.least(F.length("word"), F.length("entry"))
    close = met.select("word", "entry", edits(w, e).alias("d")).where((w == e) | ((F.col("d") <= 1) & (shorter >= MIN_REPAIRED)) | ((F.col("d") == 2) & (shorter >= MIN_TWO_EDITS - 1)))
    found = close.groupBy("word").agg(F.min("d").alias("least"), F.collect_set(F.struct("entry", "d")).alias("all"))
    return found.select("word", F.explode(F.filter("all", lambda x: x.d == F.col("least"))).alias("x")).select("word", "x.entry", "x.d")


def segments(location: Column) -> Column:
    """The parts of a location, folded, abbreviations written out, without words that name nothing."""
    text = fold(location)
    text = F.regexp_replace(text, r"\b([a-z])\.(?=\s*([a-z]\.|\W|$))", "$1")
    for short, full in ABBREVIATIONS.items():
        text = F.regexp_replace(text, rf"\b{short}\.?\s+(?=[a-z]{{3}})", full + " ")
    parts = F.split(text, r"[,;/|>&()\[\]:•·\n\t]+|\s+[-–—]+\s+|\s+(?:or|and|und|oder)\s+")
    kept = F.transform(parts, lambda s: F.filter(F.split(F.regexp_replace(s, r"['’]", ""), r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(NOISE)))
    return F.filter(kept, lambda s: F.size(s) > 0)


def country_codes(phrases: DataFrame, places: DataFrame, names: DataFrame) -> DataFrame:
    """(word, code): what distinct phrases say as countries, with up to one edit in long ones.

    A phrase that is, or repairs to, one of the reference's names (`names`, column word) is only a
    country if it is written exactly like one.
    """
    spark = places.sparkSession
    own = places.where("country_name is not null").select(F.array_join(F.flatten(segments(F.col("country_name"))), " ").alias("entry"), "country_code").union(places.select(F.lower("country_code"), "country_code"))
    aliases = spark.createDataFrame(country_aliases(), "entry string, code string").unionByName(own.select("entry", F.col("country_code").alias("code")).where("entry is not null")).groupBy("entry").agg(F.min("code").alias("code"))
    found = repair(phrases, aliases.select("entry"), two_edits=False)
    found = found.join(names.select("word", F.lit(True).alias("is_name")).distinct(), "word", "left").where("d = 0 or is_name is null")
    return found.join(aliases, "entry").groupBy("word").agg(F.min("code").alias("code"))


def link_places(rows: DataFrame, places: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(row_id, place_id): the entries of `places` that each non-null location names, or place_id 0.

    A location is cut at commas, slashes, brackets and the like. Every distinct token is repaired
    once against the tokens of the reference names (a single letter stands for the frequent ones that
    begin with it, as in `S. Xyz`); a name is a candidate of a segment if its rarest
    token is there, and it fits if all its tokens are and the soft TF-IDF cosine of the two reaches
    `threshold`. The best names of each segment count, ties all. Of their entries those fall away
    that a country in either field contradicts; an admin area in the location decides between the
    rest. Without a deciding country all entries of a name are given. Work is done on distinct
    locations, so a place that a third of all rows name costs as one; no pair of rows is ever made.

    A null location gives no row, an empty one place 0. Repeated rows are answered once per row_id
    and location. Reference entries without a city are passed over; an empty reference gives 0 for
    every row. Other columns don't matter.
    """
    asked = rows.where("location is not null").select("row_id", "location", "country")
    pairs = checkpoint(asked.select("location", "country").distinct())
    split = pairs.select("location").distinct().withColumn("segs", segments(F.col("location")))
    segs = checkpoint(split.select("location", F.posexplode_outer("segs").alias("seg", "words")))

    # reference names
    named = places.select("place_id", "country_code", fold("admin_area").alias("admin"), F.explode(F.array_distinct(F.array("city", "alt_name", two_letters("city"), two_letters("alt_name")))).alias("name")).where("name is not null")
    named = named.withColumn("tokens", F.flatten(segments(F.col("name")))).where(F.size("tokens") > 0).withColumn("key", F.array_join("tokens", " "))
    named = checkpoint(named)
    # how much the words of the reference names tell
    n_names = named.select("key").distinct().agg(F.count("*").alias("total"))
    df_tok = named.select("key", "tokens").distinct().select("key", F.explode(F.array_distinct("tokens")).alias("entry")).groupBy("entry").agg(F.count("*").alias("df"))
    vocabulary = checkpoint(df_tok.join(F.broadcast(n_names)).select("entry", "df", F.log(1 + F.col("total") / F.col("df")).alias("idf"), F.log(1 + F.col("total")).alias("top")))
    idf = vocabulary.drop("df")
    names = checkpoint(
        named.select("key", F.explode(F.array_distinct("tokens")).alias("entry")).distinct().join(idf, "entry")
        .groupBy("key").agg(F.max_by("entry", F.struct("idf", "entry")).alias("rarest"), F.collect_list(F.struct("entry", "idf")).alias("parts"), F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("norm"), F.first("top").alias("top"))
    )

    # every distinct word of the locations, repaired once
    words = checkpoint(segs.where("words is not null").select(F.explode("words").alias("word")).distinct())
    initials = words.where(F.length("word") == 1).join(vocabulary.where("df > 1").select("entry", F.substring("entry", 1, 1).alias("word")), "word").select("word", "entry", F.lit(1).alias("d"))
    # frequent words of names (`Port`, `São`) may be misspelt though short: what stands beside them decides
    short = words.where(F.length("word").between(2, MIN_REPAIRED)).join(idf.select(F.col("entry").alias("word")), "word", "left_anti").select("word", F.explode(deletes(F.col("word"))).alias("k"))
    common = vocabulary.where("df > 1 and length(entry) > 2").select("entry", F.explode(deletes(F.col("entry"))).alias("k"))
    short = short.join(common, "k").select("word", "entry").distinct().where(edits(F.col("word"), F.col("entry")) == 1).withColumn("d", F.lit(1))
    fixed = checkpoint(repair(words, idf.select("entry")).unionByName(initials).unionByName(short).distinct().join(idf, "entry"))

    # countries: whole segments, their last words, and the country field
    w = F.col("words")
    tails = lambda k: F.when(F.size(w) > k, F.array_join(F.slice(w, -k, k), " "))
    phrase_of = segs.where("words is not null").select("location", "seg", "words", F.explode(F.array(F.struct(F.size(w).alias("k"), F.array_join(w, " ").alias("word")), *[F.struct(F.lit(k).alias("k"), tails(k).alias("word")) for k in (1, 2, 3)])).alias("p")).select("location", "seg", F.size("words").alias("n"), "p.*").where("word is not null")
    fields = pairs.where("country is not null").select("country").distinct().withColumn("word", F.array_join(F.flatten(segments(F.col("country"))), " "))
    whole = F.array_join(F.filter(F.split(fold("country"), r"[^\p{L}\p{N}]+"), lambda x: x != ""), " ")
    fields = fields.withColumn("word", F.when(F.col("word") == "", whole).otherwise(F.col("word")))
    codes = checkpoint(country_codes(phrase_of.select("word").union(fields.select("word")).distinct(), places, named.select(F.col("key").alias("word")).union(fixed.where("d <= 1 and length(word) > 4").select("word")).distinct()))
    field_code = fields.join(codes, "word").select("country", F.col("code").alias("field_code"))
    exact_tail = codes.join(codes.sparkSession.createDataFrame([(a,) for a, _ in country_aliases()], "word string").unionByName(places.select(fold("country_name").alias("word"))).distinct(), "word", "left_semi")
    said = checkpoint(phrase_of.where("k = n").join(codes, "word").unionByName(phrase_of.where("k < n").join(exact_tail, "word")).groupBy("location", "seg").agg(F.max_by("code", "k").alias("code"), F.max("k").alias("k")))
    loc_codes = said.groupBy("location").agg(F.collect_set("code").alias("loc_codes"))

    # the words of the segments, without those that name a country
    left = segs.where("words is not null").join(said, ["location", "seg"], "left").withColumn("words", F.slice("words", 1, F.size("words") - F.coalesce(F.col("k"), F.lit(0)))).where(F.size("words") > 0)
    flat = left.select("location", "seg", F.explode("words").alias("word"))
    seen = flat.join(fixed.select("word", "entry", "d", "idf"), "word", "left")
    sim = 1 - F.col("d") / F.greatest(F.length("word"), F.length("entry"))
    bags = seen.groupBy("location", "seg").agg(
        F.collect_set(F.when(F.col("entry").isNotNull(), F.struct("entry", sim.alias("sim"), "idf"))).alias("bag"),
        F.count_if(F.col("entry").isNull()).alias("strange"),
    )
    cand = bags.where(F.size("bag") > 0).select("*", F.explode(F.array_distinct(F.transform("bag", lambda x: x.entry))).alias("rarest")).join(names, "rarest")
    hit = F.transform("parts", lambda p: F.struct(p.idf.alias("idf"), F.coalesce(F.array_max(F.transform(F.filter("bag", lambda b: b.entry == p.entry), lambda b: b.sim)), F.lit(0.0)).alias("sim")))
    scored = (
        cand.withColumn("hit", hit).where(~F.exists("hit", lambda h: h.sim == 0))
        .withColumn("dot", F.aggregate("hit", F.lit(0.0), lambda a, h: a + h.idf * h.idf * h.sim))
        .withColumn("own", F.aggregate("parts", F.lit(0.0), lambda a, p: a + p.idf * p.idf))
        .withColumn("seg_norm", F.sqrt(F.col("own") + F.col("strange") * F.col("top") * F.col("top") * 0.5 + F.aggregate("bag", F.lit(0.0), lambda a, b: a + F.when(F.exists("parts", lambda p: p.entry == b.entry) | (b.sim < 1), 0.0).otherwise(b.idf * b.idf))))
        .withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("seg_norm")), 6))
        .where(F.col("score") >= threshold)
    )
    # a segment that is an admin area as written is no misspelt city
    regions = named.where("admin is not null").select(F.array_join(F.flatten(segments(F.col("admin"))), " ").alias("phrase")).distinct()
    region = left.select("location", "seg", F.array_join("words", " ").alias("phrase")).join(regions, "phrase").select("location", "seg", F.lit(True).alias("is_region"))
    scored = scored.join(region, ["location", "seg"], "left").where(F.col("is_region").isNull() | ~F.exists("hit", lambda h: h.sim < 1))
    chosen = scored.withColumn("best", F.max("score").over(Window.partitionBy("location", "seg"))).where("score = best").select("location", "seg", "key")
    entries = chosen.join(named.select("key", "place_id", "country_code", "admin").distinct(), "key")
    areas = segs.where("words is not null").groupBy("location").agg(F.collect_set(F.array_join("words", " ")).alias("areas"))
    entries = checkpoint(entries.join(areas, "location"))

    full = pairs.join(field_code, "country", "left").join(loc_codes, "location", "left").join(entries, "location")
    fits = (F.col("field_code").isNull() | (F.col("field_code") == F.col("country_code"))) & (F.col("loc_codes").isNull() | F.array_contains("loc_codes", F.col("country_code")))
    full = full.where(fits).withColumn("told", F.array_contains("areas", F.col("admin")).cast("int"))
    full = full.withColumn("ck", F.coalesce("country", F.lit("\0"))).withColumn("top", F.max("told").over(Window.partitionBy("location", "ck", "seg", "key"))).where("told = top or top is null")
    answer = full.select("location", "ck", "place_id").distinct()
    out = asked.withColumn("ck", F.coalesce("country", F.lit("\0"))).join(answer, ["location", "ck"], "left")
    return out.select("row_id", F.coalesce("place_id", F.lit(0)).cast("int").alias("place_id")).distinct()
