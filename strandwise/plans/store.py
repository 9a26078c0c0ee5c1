"""Atlases kept by parts of the genome, with every state of them named by one manifest.

A part holds the chromosomes whose ids have one remainder, so that a genome of a few
chromosomes has one in each and an assembly of many thousand contigs has no more
folders than that. Folders of data are written once and never changed. A manifest lists, for each table
and part, the folders that hold it, with the runs that have been added and
the parameters of the final sets. Writers put new folders beside the old ones
and then name a new manifest by one rename, so a writer that breaks off, wherever
it does, has changed nothing, and readers keep the state that they began with.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.intervals import chromosome_of
from ..operators import transcripts as T
from ..operators.transcripts import Parameters
from ..sources.shared import delete, names_in, put_new, stored, transient
from .atlas import Atlas, build_final, finish_prep

#: Parts of a new store.
PARTS = 32
#: Tables of a final set, and the column that tells a row's chromosome where there is no other.
FINAL = {"facts": "id", "sources": "id", "genes": "transcript_id", "noncoding": "transcript_id"}
#: Rows of a row group, in the order of their starts, so that a range of positions opens few groups.
GROUP_BYTES = 4 << 20


@dataclass(frozen=True)
class Manifest:
    """A state of a store. ``tables`` has folders by table and part, ``longest`` the longest
    interval of a table, ``runs`` the tags of each run, ``tags`` those of prep by part, ``sets`` the parameters of each final set."""

    number: int = 0
    runs: dict[str, int] = field(default_factory=dict)
    tags: dict[str, int] = field(default_factory=dict)
    sets: dict[str, dict] = field(default_factory=dict)
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    longest: dict[str, int] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    parts: int = PARTS

    def part(self, chromosome="chr") -> Column:
        return F.pmod(F.col(chromosome).cast("long"), F.lit(self.parts))

    def within(self, df: DataFrame, parts: set[str]) -> DataFrame:
        """Rows of df whose chromosome is in one of the parts."""
        return df.where(self.part().isin([int(x) for x in parts]))


class Conflict(RuntimeError):
    """Another writer has committed meanwhile; read the current state and try again."""


class AtlasStore:
    """Tables of one atlas below a path in the shared store. A path for each genome, cell type and stage keeps atlases apart."""

    def __init__(self, spark: SparkSession, path: str, pinned: Manifest | None = None):
        self.spark, self.path, self._pinned = spark, path.rstrip("/"), pinned

    def manifest(self) -> Manifest:
        """The pinned state, or the last one committed."""
        if self._pinned:
            return self._pinned
        numbers = self.numbers()
        return self.manifest_of(numbers[-1]) if numbers else Manifest()

    def numbers(self) -> list[int]:
        return sorted(int(x.removesuffix(".json")) for x in names_in(self.spark, f"{self.path}/manifests") if x.removesuffix(".json").isdigit() and x.endswith(".json"))

    def manifest_of(self, number: int) -> Manifest:
        text = self.spark.read.text(f"{self.path}/manifests/{number:08d}.json", wholetext=True).first()[0]
        known = json.loads(text)
        if "parts" not in known:
            raise ValueError(f"{self.path} has a folder for each chromosome, as earlier versions wrote it; save its atlas anew")
        return Manifest(**known)

    def pinned(self, number: int | None = None) -> AtlasStore:
        """The store as it is now, or as it was, whatever is committed later."""
        return AtlasStore(self.spark, self.path, self.manifest() if number is None else self.manifest_of(number))

    def commit(self, new: Manifest) -> Manifest:
        """Make ``new``, drawn from the state before it, the current one."""
        new = replace(new, number=new.number + 1)
        if not put_new(self.spark, f"{self.path}/manifests/{new.number:08d}.json", json.dumps(asdict(new))):
            raise Conflict(f"state {new.number} is there already")
        return new

    def write(self, state: Manifest, name: str, df: DataFrame, key: str = "id", add: bool = False, parts: set[str] | None = None) -> Manifest:
        """Write rows to new folders, and the state in which they are the table.

        Parts that df has replace what the table held of them, or go beside it with ``add``.
        ``parts`` names those that are replaced also where df has no rows of them; None means all.
        Rows are in the order of their starts within a file. Ranges are drawn from df before
        it is written, so it had better be a table that is there.
        """
        if "chr" not in df.columns:
            df = df.withColumn("chr", chromosome_of(key))
        folder, schema = uuid.uuid4().hex[:12], df.schema
        order = ["_part", "chr", "s" if "s" in df.columns else key]
        dealt = df.withColumn("_part", state.part()).repartitionByRange(*order).sortWithinPartitions(*order)
        dealt.write.option("parquet.block.size", GROUP_BYTES).partitionBy("_part").parquet(f"{self.path}/data/{name}/{folder}")
        found = [x.removeprefix("_part=") for x in names_in(self.spark, f"{self.path}/data/{name}/{folder}") if x.startswith("_part=")]
        before = state.tables.get(name, {})
        if not add:
            before = {} if parts is None else {c: x for c, x in before.items() if c not in parts}
        table = {**before, **{c: [*(before.get(c, []) if add else []), folder] for c in found}}
        longest = state.longest
        if "s" in df.columns and "e" in df.columns:
            widest = self.spark.read.schema(schema).parquet(f"{self.path}/data/{name}/{folder}").agg(F.max(F.col("e") - F.col("s"))).first()[0] if found else 0
            longest = {**longest, name: max(longest.get(name, 0) if before else 0, widest or 0)}
        schemas = {**state.schemas, name: schema.jsonValue()}
        return replace(state, tables={**state.tables, name: table}, longest=longest, schemas=schemas)

    def read(self, name: str, state: Manifest | None = None, parts: set[str] | None = None) -> DataFrame:
        """A table of the state; only the folders of the parts that are asked for are listed and opened."""
        state = state or self.manifest()
        if name not in state.tables:
            raise KeyError(f"no table {name} in state {state.number}")
        schema = StructType.fromJson(state.schemas[name])
        found = [f"{self.path}/data/{name}/{x}/_part={c}" for c, folders in state.tables[name].items() for x in folders if parts is None or c in parts]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*found) if found else self.spark.createDataFrame([], schema)

    def read_range(self, name: str, chromosome, start: int, end: int, state: Manifest | None = None) -> DataFrame:
        """Rows of a table that overlap the closed range. An interval that begins further before it than the longest one is long cannot, so row groups are skipped on both sides."""
        state = state or self.manifest()
        rows = self.read(name, state, {str(int(chromosome) % state.parts)})
        return rows.where(F.col("s").between(start - state.longest.get(name, 0), end) & (F.col("e") >= start) & (F.col("chr") == int(chromosome)))

    def transcripts(self, key: str = "final", state: Manifest | None = None) -> DataFrame:
        """A final set with its scores, from what is kept of each transcript and the totals of the state."""
        state = state or self.manifest()
        p = Parameters(**state.sets[key])
        totals = self.spark.createDataFrame([(sum(state.tags.values()), len(state.runs) + bool(p.count_pseudo_run))], "total_tags long, n_runs long")
        return T.scored(self.read(f"{key}.facts", state), totals)

    def clean(self, keep: int = 1) -> None:
        """Delete the states before the last ``keep``, and all folders that no state left names. No writer may be under way."""
        numbers = self.numbers()
        named: dict[str, set[str]] = {}
        for n in numbers[-keep:]:
            for name, table in self.manifest_of(n).tables.items():
                named.setdefault(name, set()).update(x for folders in table.values() for x in folders)
        for n in numbers[:-keep]:
            delete(self.spark, f"{self.path}/manifests/{n:08d}.json")
        for name in names_in(self.spark, f"{self.path}/data"):
            for folder in names_in(self.spark, f"{self.path}/data/{name}"):
                if folder not in named.get(name, ()):
                    delete(self.spark, f"{self.path}/data/{name}/{folder}")


def _tags_by_part(sources: DataFrame, state: Manifest) -> dict[str, int]:
    return {str(r.part): r.n for r in sources.groupBy(state.part().alias("part")).agg(F.sum("tag_count").alias("n")).collect()}


def _with_final(store: AtlasStore, state: Manifest, key: str, atlas: Atlas, p: Parameters, parts: set[str] | None = None) -> Manifest:
    for name, own in FINAL.items():
        df = getattr(atlas, name)
        state = store.write(state, f"{key}.{name}", stored(df, name) if name in ("genes", "noncoding") else df, own, parts=parts)
    return replace(state, sets={**state.sets, key: asdict(p)})


def save_atlas(store: AtlasStore, atlas: Atlas, runs: DataFrame, p: Parameters, key: str = "final") -> Manifest:
    """Prep tables, which further final sets can be built from, and one final set."""
    state = store.manifest()
    with transient(store.spark):
        for name in ("prep", "prep_sources"):
            state = store.write(state, name, getattr(atlas, name))
        real = {str(r.id): r.total_tags for r in runs.where("total_tags is not null").collect()}
        state = replace(state, runs=real, tags=_tags_by_part(atlas.prep_sources, state))
        return store.commit(_with_final(store, state, key, atlas, p))


def rebuild_final(store: AtlasStore, genes: DataFrame, noncoding: DataFrame, p: Parameters, key: str = "final") -> Manifest:
    """A final set, with other parameters or under another key beside those that are there, from the prep tables that are kept."""
    state = store.manifest()
    with transient(store.spark):
        atlas = build_final(store.read("prep", state), store.read("prep_sources", state), genes, noncoding, run_table(store, state), p)
        return store.commit(_with_final(store, state, key, atlas, p))


def run_table(store: AtlasStore, state: Manifest) -> DataFrame:
    """(id, total_tags) of the runs of a state, and the pseudo-run of the annotation, without a total."""
    rows = [*((int(r), n) for r, n in state.runs.items()), (0, None)]
    return store.spark.createDataFrame(rows, "id int, total_tags long")


def add_runs(store: AtlasStore, tags: DataFrame, p: Parameters, genes: DataFrame, noncoding: DataFrame) -> Manifest:
    """New runs (run_id, chr, strand, s, e, refseq, tag_count), from proto-transcripts to every final set that is kept.

    Only the parts that they touch are stitched and joined anew. What the scores of
    other transcripts take from all runs, the number of runs and of tags, is
    in the state and not in their rows. Runs that the state has already are
    left out, so a repeated call changes nothing; one with another number of
    tags raises. All of it is one commit: whatever breaks off before leaves the old state.
    """
    state = store.manifest()
    totals = {str(r.run_id): r.n for r in tags.groupBy("run_id").agg(F.sum("tag_count").alias("n")).collect()}
    other = sorted(r for r, n in totals.items() if state.runs.get(r, n) != n)
    if other:
        raise ValueError(f"runs {', '.join(other)} have been added with other tags")
    new = sorted(int(r) for r in totals if r not in state.runs)
    if not new:
        return state
    with transient(store.spark):
        protos = stored(T.proto_transcripts(tags.where(F.col("run_id").isin(new)), p), "new-protos")
        touched = {str(r.part) for r in protos.select(state.part().alias("part")).distinct().collect()}
        state = store.write(state, "protos", protos, key="run_id", add=True)
        own_genes, own_noncoding = (state.within(df, touched) for df in (genes, noncoding))
        rows = T.stitch_rows(store.read("protos", state, touched), p)
        stitched = stored(T.stitched_transcripts(rows), "stitched")
        sources = stored(T.source_rows(rows, stitched), "sources")
        state = store.write(state, "prep_sources", sources, parts=touched)
        prep = stored(finish_prep(stitched, sources, own_genes, p), "prep")
        state = store.write(state, "prep", prep, parts=touched)
        kept = {c: n for c, n in state.tags.items() if c not in touched}
        state = replace(state, runs={**state.runs, **{str(r): totals[str(r)] for r in new}}, tags={**kept, **_tags_by_part(sources, state)})
        known = run_table(store, state)
        for key in list(state.sets) or ["final"]:
            own = Parameters(**state.sets[key]) if key in state.sets else p
            state = _with_final(store, state, key, build_final(prep, sources, own_genes, own_noncoding, known, own), own, touched)
        return store.commit(state)
