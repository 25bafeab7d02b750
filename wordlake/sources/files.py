"""Source files: dictionary CSV, dump of JSON lines, WordNet XML, term lists."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlake.functions.normalize import norm_key
from wordlake.operators.lookup import import_terms

LINKS = "array<struct<word:string>>"
# The dump's fields that are read.
RELATION_FIELDS = ["alt_of", "form_of", "hypernyms", "hyponyms", "coordinate_terms", "meronyms", "holonyms", "troponyms"]
DUMP = (
    f"struct<word:string,lang_code:string,pos:string,synonyms:{LINKS},antonyms:{LINKS},derived:{LINKS},related:{LINKS},hypernyms:{LINKS},hyponyms:{LINKS},coordinate_terms:{LINKS},meronyms:{LINKS},"
    "sounds:array<struct<ipa:string,enpr:string,tags:array<string>>>,senses:array<struct<glosses:array<string>,raw_glosses:array<string>,senseid:array<string>,"
    f"examples:array<struct<text:string,type:string>>,synonyms:{LINKS},antonyms:{LINKS},related:{LINKS},{','.join(f'{f}:{LINKS}' for f in RELATION_FIELDS)}>>>"
)
CSV_FIELDS = ["word", "pos", "definition", "translation", "phonetic", "frq", "bnc", "oxford"]


def read_dictionary_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; ``line`` keeps the files' order."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    cols = [F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in CSV_FIELDS]
    return raw.select(*cols, F.monotonically_increasing_id().alias("line")).withColumn("key", norm_key(F.col("word")))


def parse_dump(lines: DataFrame, lang: str = "en") -> tuple[DataFrame, DataFrame]:
    """(records of the language, counts) from a table of (line, value) rows of JSON text."""
    parsed = lines.withColumn("bad", F.try_parse_json("value").isNull()).withColumn("r", F.from_json("value", DUMP))
    records = parsed.filter(~F.col("bad") & (F.col("r.lang_code") == lang)).select("line", "r.*").withColumn("key", norm_key(F.col("word"))).filter("key <> ''")
    counts = parsed.agg(F.count("*").alias("n_lines"), F.count_if("bad").alias("n_invalid"), F.count_if(~F.col("bad") & (F.col("r.lang_code") == lang)).alias("n_language"))
    return records, counts


def read_dump_jsonl(spark: SparkSession, path: str, lang: str = "en", parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Dump of JSON lines.

    A compressed file is one split: it is read by one task, which deals its lines out to ``parts``
    tasks (by default as many as the session has cores) before they are parsed.
    """
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    if parts is None and path.endswith((".gz", ".bz2", ".zst", ".xz")):
        parts = spark.sparkContext.defaultParallelism
    return parse_dump(lines.repartition(parts) if parts else lines, lang)


@dataclass
class WordNet:
    """The five tables of a WordNet file."""

    entries: DataFrame
    senses: DataFrame
    sense_relations: DataFrame
    synsets: DataFrame
    synset_relations: DataFrame


ENTRY_XML = (
    "_id string, Lemma struct<_writtenForm:string,_partOfSpeech:string,Pronunciation:array<struct<_VALUE:string,_variety:string>>>,"
    "Sense array<struct<_id:string,_synset:string,_n:string,SenseExample:array<string>,SenseRelation:array<struct<_relType:string,_target:string>>>>"
)
SYNSET_XML = "_id string, _ili string, _partOfSpeech string, Definition array<struct<_VALUE:string,_sourceSense:string>>, Example array<string>, SynsetRelation array<struct<_relType:string,_target:string>>"


def file_digest(spark: SparkSession, path: str) -> str:
    """sha256 of a file; of several files, over their digests in order, so their names do not count.

    The files' bytes are digested in tasks, one file each (up to 2 GB); only the digests are gathered.
    """
    each = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("d"))
    digests = sorted(r["d"] for r in each.collect())
    return digests[0] if len(digests) == 1 else hashlib.sha256("\n".join(digests).encode()).hexdigest()


def read_wordnet_xml(spark: SparkSession, path: str, release: dict[str, str] | None = None, digest: str | None = None) -> WordNet:
    """Five tables from a WordNet XML file; rows without ids go.

    Refused before anything is read if the file's digest or the release's attributes are others.
    """
    if digest is not None and (got := file_digest(spark, path)) != digest:
        raise ValueError(f"another file: {got}")
    if release:
        head = spark.read.format("xml").option("rowTag", "Lexicon").schema(", ".join(f"_{k} string" for k in release)).load(path).filter(" or ".join(f"_{k} is not null" for k in release)).limit(1).collect()
        got = {k: head[0][f"_{k}"] for k in release} if head else {}
        if got != release:
            raise ValueError(f"another release: {got}")
    raw = spark.read.format("xml").option("rowTag", "LexicalEntry").schema(ENTRY_XML).load(path).filter("_id is not null")
    entries = raw.select(F.col("_id").alias("entry_id"), F.col("Lemma._writtenForm").alias("written"), F.col("Lemma._partOfSpeech").alias("pos"), F.col("Lemma.Pronunciation").alias("sounds"))
    entries = entries.withColumn("key", norm_key(F.col("written"))).filter("key <> ''")
    s = raw.select(F.col("_id").alias("entry_id"), F.posexplode("Sense").alias("ord", "s")).filter("s._id is not null and s._synset is not null")
    n = F.col("s._n").try_cast("int")
    senses = s.select("entry_id", F.col("s._id").alias("sense_id"), F.col("s._synset").alias("synset_id"), F.when(n > 0, n).otherwise(F.col("ord") + 1).alias("sense_order"), F.coalesce("s.SenseExample", F.array()).alias("examples"))
    links = s.select(F.col("s._id").alias("sense_id"), F.posexplode("s.SenseRelation").alias("ord", "r"))
    sense_relations = links.select("sense_id", "ord", F.col("r._relType").alias("relation"), F.col("r._target").alias("target")).filter("target is not null")
    raw = spark.read.format("xml").option("rowTag", "Synset").schema(SYNSET_XML).load(path).filter("_id is not null")
    texts = F.transform(F.coalesce("Definition", F.array()), lambda d: F.struct(d["_VALUE"].alias("text"), d["_sourceSense"].alias("source_sense")))
    synsets = raw.select(F.col("_id").alias("synset_id"), F.col("_ili").alias("ili"), F.col("_partOfSpeech").alias("pos"), texts.alias("definitions"), F.coalesce("Example", F.array()).alias("examples"))
    links = raw.select(F.col("_id").alias("synset_id"), F.posexplode("SynsetRelation").alias("ord", "r"))
    synset_relations = links.select("synset_id", "ord", F.col("r._relType").alias("relation"), F.col("r._target").alias("target")).filter("target is not null")
    return WordNet(entries, senses, sense_relations, synsets, synset_relations)


def read_term_lists(spark: SparkSession, path: str) -> DataFrame:
    """(path, terms) of whole text files."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    return import_terms(files, "path", "text")
