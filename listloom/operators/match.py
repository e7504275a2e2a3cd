"""Matching of incoming rows to known contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.functions.clean import mail_hash
from listloom.operators.joins import inner_on, key_set, left_many, left_one, natural, with_side
from listloom.operators.skew import hot_keys, spread


# So many hashes are broadcast to a store's at most: some 40 MB.
_FEW_KEYS = 500_000

# Signs of a run by which words are looked for.
_SEED = 3

# So many words are broadcast at most: some 10 MB.
_FEW_WORDS = 100_000


def join_key(df: DataFrame, reference: DataFrame, wanted: str) -> str | None:
    """The wanted key, else the first shared column, else None."""
    if wanted in df.columns and wanted in reference.columns:
        return wanted
    shared = [c for c in df.columns if c in reference.columns]
    return shared[0] if shared else None


def map_existing(
    df: DataFrame, reference: DataFrame, key: str = "md5",
    exist: str = "exist", new: str = "new", hot: list | None = None,
) -> DataFrame:
    """Flag each row as existing in or new to the reference.

    Without a shared column both flags stay false. Reference keys are made
    distinct first, so every input row gives one output row.
    """
    on = join_key(df, reference, key)
    if on is None:
        return df.withColumns({exist: F.lit(False), new: F.lit(False)})
    known = key_set(reference, on, "_k").withColumn("_known", F.lit(True))
    flagged = left_one(df, known, on, "_k", repeats=True, hot=hot)
    found = F.coalesce(F.col("_known"), F.lit(False))
    return flagged.withColumns({exist: found, new: ~found}).drop("_known")


def match_counts(flagged: DataFrame, exist: str = "exist", new: str = "new", by: list[str] | None = None) -> DataFrame:
    """Counters of a match: rows in, rows out, existing and new."""
    return flagged.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("initial"),
        F.count(F.lit(1)).alias("sorted"),
        F.count_if(F.col(exist)).alias("n_exist"),
        F.count_if(F.col(new)).alias("n_new"),
    )


def lookup_hash(df: DataFrame, hashes: DataFrame, exist: str = "exist", new: str = "insert", few: bool = False) -> DataFrame:
    """``map_existing`` by md5, with the contact number of the match as ``pg_id``.

    With ``few`` the rows are counted first, and if there are ``_FEW_KEYS`` at most, their hashes are broadcast to
    the known ones, which then stay where they lie; only those that come in go to the match. ``df`` is read three times then.
    """
    known = hashes.filter(F.col("md5").isNotNull())
    if few and df.count() <= _FEW_KEYS:
        known = known.join(F.broadcast(df.select("md5").distinct()), "md5", "left_semi")
    known = known.groupBy(F.col("md5").alias("_k"))
    known = known.agg(F.min("mail_id").alias("pg_id"))
    joined = left_one(df, known, "md5", "_k", repeats=True)
    found = F.col("pg_id").isNotNull()
    return joined.withColumns({exist: found, new: ~found})


def interests_of(
    export: DataFrame, matches: DataFrame, names: DataFrame,
    hot_contacts: list | None = None, hot_interests: list | None = None,
) -> DataFrame:
    """Interests and scores of the contacts in an export of (id, mail)."""
    people = export.select(F.col("id").alias("mail_id"), "mail").distinct()
    matches = matches.select("mail_id", "appetence_id", "score")
    named = inner_on(matches, names.select("id", "interet"), "appetence_id", "id", many="rows", hot=hot_interests)
    if hot_contacts is None:
        hot_contacts = hot_keys(matches, "mail_id")
    rows = inner_on(people, named, "mail_id", hot=hot_contacts)
    return rows.select("mail_id", "mail", "interet", "score")


def hash_enrich(outside: DataFrame, known: DataFrame, columns: list[str]) -> DataFrame:
    """Add columns known by md5 to an outside list, keeping the list's own mail."""
    hashed = outside.withColumn("_md5", mail_hash("mail", normalise=False))
    side = known.select(F.col("md5").alias("_side"), *columns)
    joined = spread(hashed, side, "_md5", "_side", with_side("left", "_md5"), unique=False)
    return joined.drop("_md5")


def append_identity(mails: DataFrame, identities: DataFrame) -> DataFrame:
    """Identity columns for a list of distinct mails; mails without one stay."""
    return left_many(mails, identities.withColumnRenamed("mail", "_k"), "mail", "_k")


def audit_match(outside: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of an outside file found in the base, on all shared columns."""
    return natural(outside, known, "inner")


def overlap_by_file(
    candidates: DataFrame, reference: DataFrame, file: str, key: str, hot: list | None = None
) -> DataFrame:
    """Match counters of one reference list against many files in one pass."""
    return match_counts(map_existing(candidates, reference, key, hot=hot), by=[file])


def _grams(df: DataFrame, text: str, size: int) -> DataFrame:
    """``df`` with one row per run of ``size`` signs of a text, as ``gram``, and its place from 1 on, as ``at``."""
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return df.select("*", F.explode(places).alias("at")).withColumn("gram", F.substring(F.col(text), F.col("at"), F.lit(size)))


def _seeds(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """(mot_list_id, mot, gram, shift): each word by the one of its grams that fewest addresses hold, and how far into the word it stands."""
    grams = _grams(words.select("mot_list_id", "mot"), "mot", _SEED).select("mot_list_id", "mot", (F.col("at") - 1).alias("shift"), "gram")
    # Counted before the shuffle: there are no more grams than texts of three signs.
    often = pieces.join(grams.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    ranked = grams.join(often, "gram", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    best = F.min(F.struct("often", "shift", "gram")).alias("b")
    return ranked.groupBy("mot_list_id", "mot").agg(best).select("mot_list_id", "mot", F.col("b.gram").alias("gram"), F.col("b.shift").alias("shift"))


def word_hits(mails: DataFrame, words: DataFrame, mail: str = "mail") -> DataFrame:
    """Contacts whose address contains a word, as (mail_id, mot_list_id).

    Each word is looked for by its rarest run of three signs. Addresses are cut into such runs only, as many as an
    address is long, however many words of however many lengths there are; where a run fits, the whole word is
    verified at its place. Words of one or two signs are looked for as they are. A contact with one row gives each word once.

    Spark takes the runs for no larger than the file of the addresses, so it might broadcast them. Therefore the words are
    counted first, up to ``_FEW_WORDS``: no more than these are broadcast to the runs, more meet them in a merge join.
    """
    words = words.filter(F.length("mot") > 0).select(F.col("id").alias("mot_list_id"), "mot")
    text = mails.select(F.col("id").alias("mail_id"), F.col(mail).alias("_text"))
    how = "broadcast" if words.limit(_FEW_WORDS + 1).count() <= _FEW_WORDS else "merge"

    def cut(size: int) -> DataFrame:
        return _grams(text, "_text", size)

    def found(pieces: DataFrame, seeds: DataFrame) -> DataFrame:
        # The word's first place in the address, 0 if it has none: it is verified, and counts once.
        hit = (F.position("mot", "_text") == F.col("at") - F.col("shift")) & (F.col("at") > F.col("shift"))
        return pieces.join(seeds.hint(how), "gram").filter(hit).select("mail_id", "mot_list_id")

    hits = found(cut(_SEED), _seeds(words.filter(F.length("mot") >= _SEED), cut(_SEED)))
    for size in range(1, _SEED):
        short = words.filter(F.length("mot") == size).select("mot_list_id", "mot", F.col("mot").alias("gram"), F.lit(0).alias("shift"))
        hits = hits.unionByName(found(cut(size), short))
    return hits


def word_flag(mails: DataFrame, words: DataFrame, flag: str = "exclusion_mot_cle") -> DataFrame:
    """True where the address holds an excluded word."""
    hits = key_set(word_hits(mails, words.filter("exclusion")), "mail_id", "_k")
    flagged = left_one(mails, hits.withColumn(flag, F.lit(True)), "id", "_k")
    return flagged.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


