"""The whole build: scores, imports, covering, tiles, containment, export; every artifact only when it isn't fresh.

python -m tilewright.plans.build places|osm|divisions|all|density|idf|covering --config build.json

A run is published as tiles/<source>/<time>/<first six digits>/<tile>.json.gz with its record_tiles, collection.json
and, last, manifest.json; then tiles/<source>/current points at it and all but the two newest whole runs go.
"""

from __future__ import annotations

import argparse
import contextlib
import json
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import containment, covering, export, importers, lookups, tiles
from ..sources import scans, sinks
from ..sources.hadoop import Files


@dataclass
class Config:
    """Where things lie and what the stages use.

    inputs: name -> glob (places; nodes, ways, relations; divisions, areas), or osm -> a folder with type=node and so
    on. Where a pattern has the segment /*/, its newest release counts. names: the collection of each source. tiles:
    source, license and attribution that every tile and description carries, or such a dict for each source; ABOUT has
    what isn't given.
    """

    output: str
    inputs: dict[str, str]
    box: tuple[float, float, float, float] = importers.WORLD
    most: int = 1000
    low: int = 6
    summary: int = 10_000
    repo: str = "places.example"
    generated_at: str = ""
    names: dict[str, str] = field(default_factory=dict)
    tiles: dict = field(default_factory=dict)


#: Where the data of each source comes from; fixed values.
ABOUT = {
    "places": {"source": "https://overturemaps.org/", "license": "https://docs.overturemaps.org/attribution/", "attribution": "https://docs.overturemaps.org/attribution/"},
    "osm": {"source": "https://www.openstreetmap.org/", "license": "https://opendatacommons.org/licenses/odbl/1-0/", "attribution": "https://www.openstreetmap.org/copyright"},
    "divisions": {"source": "https://overturemaps.org/", "license": "https://docs.overturemaps.org/attribution/", "attribution": "https://docs.overturemaps.org/attribution/"},
}


def load(path: str) -> Config:
    """Config from JSON, or from YAML where a reader for it is installed."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        return Config(**yaml.safe_load(text))
    return Config(**json.loads(text))


class Build:
    """One build: every artifact is looked at once, and made where it isn't fresh; made lists those, in order."""

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        self.when = config.generated_at or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
        self.made: list[str] = []
        #: Folders of tiles that the last run published wrote anew.
        self.written: list[str] = []
        self._known: dict[str, DataFrame] = {}
        inputs = dict(config.inputs)
        if "osm" in inputs:
            root = inputs.pop("osm").rstrip("/")
            inputs |= {f"{t}s": f"{root}/type={t}" for t in scans.OSM_PARTS}
        # Divisions and their areas, and the three kinds of elements, come from one release each.
        for group in (("places",), ("nodes", "ways", "relations"), ("divisions", "areas")):
            released = [n for n in group if "/*/" in inputs.get(n, "")]
            if released:
                inputs |= zip(released, scans.newest_release(spark, *[inputs[n] for n in released]))
        config.inputs = inputs

    def name(self, source: str) -> str:
        return self.config.names.get(source, source)

    def about(self, source: str) -> dict[str, str]:
        """source, license and attribution of a source."""
        given = self.config.tiles
        own = given.get(source, {}) if any(isinstance(v, dict) for v in given.values()) else given
        return ABOUT[source] | own

    @contextlib.contextmanager
    def alone(self):
        """No two builds write to one output; a lock that a broken build left is to be removed by hand."""
        files, lock = Files(self.spark), f"{self.config.output}/.lock"
        if not files.claim(lock):
            raise RuntimeError(f"{lock}: another build is at work")
        try:
            yield
        finally:
            files.delete(lock)

    def read(self, name: str) -> DataFrame:
        return scans.scan(self.spark, self.config.inputs[name])

    def path(self, name: str) -> str:
        return f"{self.config.output}/{name}"

    def artifact(self, name: str, make, inputs: list[str], parameters: dict, key: str, write=sinks.write_sorted) -> DataFrame:
        """The table of that name, made again only when its inputs (paths or globs) or parameters changed, and once a
        build: what one part of a build reads no other replaces."""
        if name not in self._known:
            path = self.path(name)
            if not sinks.is_fresh(self.spark, path, inputs, parameters):
                sinks.make_artifact(self.spark, lambda to: write(make(), to, key), path, inputs, parameters)
                self.made.append(name)
            self._known[name] = scans.text_keys(self.spark, path)
        return self._known[name]

    def density(self) -> DataFrame | None:
        """Scores of the finest tiles, from places; None in a build without."""
        if "places" not in self.config.inputs:
            return None
        middle = lambda a, b: (F.col(f"bbox.{a}") + F.col(f"bbox.{b}")) / 2
        fresh = "density" not in self._known
        dens = self.artifact("density", lambda: lookups.density(self.read("places"), middle("xmin", "xmax"), middle("ymin", "ymax")), [self.config.inputs["places"]], {}, "tile_qk15")
        if fresh:
            lookups.require_unique(dens, "density", "tile_qk15")
        return dens

    def idf(self) -> DataFrame:
        """Scores of the categories of places."""
        fresh = "idf" not in self._known
        idf = self.artifact("idf", lambda: lookups.rarity(self.read("places"), F.col("categories.primary")), [self.config.inputs["places"]], {}, "category")
        if fresh:
            lookups.require_unique(idf, "idf", "category")
        return idf

    def scores(self) -> tuple[DataFrame, DataFrame]:
        return self.density(), self.idf()

    def shapes(self) -> DataFrame:
        """The areas of every division as one, unusable ones counted."""
        return self.artifact("shapes", lambda: importers.area_shapes(self.read("areas"), self.config.box), [self.config.inputs["areas"]], {"box": list(self.config.box)}, "id")

    def places(self, source: str) -> tuple[DataFrame, str]:
        """The imported table and the name of its key."""
        c, parameters = self.config, {"box": list(self.config.box)}
        dens = self.density()
        scored = [self.path("density")] if dens is not None else []
        if source == "places":
            idf = self.idf()
            make = lambda: importers.import_places(self.read("places"), c.box, dens, idf)
            return self.artifact("places", make, [c.inputs["places"], *scored, self.path("idf")], parameters, "qk17"), "id"
        if source == "osm":
            parts = ("nodes", "ways", "relations")
            make = lambda: importers.import_osm(*map(self.read, parts), c.box, dens, lookups.osm_rarity(*map(self.read, parts)))
            return self.artifact("osm", make, [*[c.inputs[p] for p in parts], *scored], parameters, "qk17"), "rkey"
        shapes = self.shapes()
        make = lambda: importers.import_divisions(self.read("divisions"), self.read("areas"), c.box, dens, shapes=shapes)
        return self.artifact("divisions", make, [c.inputs["divisions"], self.path("shapes"), *scored], parameters, "qk17"), "id"

    def covering(self) -> DataFrame:
        divisions, _ = self.places("divisions")
        bounds = divisions.select(F.col("id").alias("boundary_id"), "level", "geom", "xmin", "ymin", "xmax", "ymax")
        return self.artifact("covering", lambda: covering.cover(bounds), [self.path("divisions")], {}, "tile_qk")

    def assignments(self, places: DataFrame, key: str, source: str) -> DataFrame:
        def make() -> DataFrame:
            keyed = places.withColumn("place_id", F.col(key))
            always = tiles.always_shown(F.col("subtype")) if source == "divisions" else None
            regular = tiles.assign(keyed, self.config.most, self.config.low)
            summary = tiles.assign_summary(keyed, self.config.summary, self.config.most, always)
            if source == "divisions":
                cover = self.covering()
                chosen = cover.join(summary.select(F.col("place_id").alias("boundary_id")).distinct(), "boundary_id", "left_semi")
                regular = tiles.references(cover, regular.filter(F.length("tile_qk") >= self.config.low)).unionByName(regular).distinct()
                summary = tiles.references(chosen, summary).unionByName(summary).distinct()
            return tiles.bands(regular, summary)

        inputs = [self.path(source)]
        if source == "divisions":
            self.covering()
            inputs.append(self.path("covering"))
        before = len(self.made)
        found = self.artifact(f"{source}_assignments", make, inputs, {"most": self.config.most, "low": self.config.low, "summary": self.config.summary}, "tile_qk")
        if len(self.made) > before and (double := tiles.repeated(found).first()):
            raise ValueError(f"{double.place_id} stands {double.n} times in tile {double.tile_qk}")
        return found

    def related(self, places: DataFrame, key: str, source: str, assigned: DataFrame) -> DataFrame | None:
        """What lies within which division; None in a build without divisions."""
        if "divisions" not in self.config.inputs:
            return None
        divisions, _ = self.places("divisions")
        inputs = [self.path(source), self.path(f"{source}_assignments"), self.path("divisions")]
        if source == "divisions":
            matched = lambda: containment.hierarchy(self.read("divisions"), divisions)
            inputs.append(self.config.inputs["divisions"])
        else:
            cover = self.covering()
            lon, lat = ("longitude", "latitude") if source == "osm" else ("(bbox.xmin + bbox.xmax) / 2", "(bbox.ymin + bbox.ymax) / 2")
            spots = places.select(F.col(key).alias("place_id"), F.expr(lon).alias("lon"), F.expr(lat).alias("lat"), "qk17")
            matched = lambda: containment.matches(spots, cover)
            inputs.append(self.path("covering"))
        names = divisions.select(F.col("id").alias("boundary_id"), F.col("names.primary").alias("name"))
        make = lambda: containment.relations(matched(), assigned, names, self.name("divisions"))
        return self.artifact(f"{source}_containment", make, inputs, {"collection": self.name("divisions")}, "tile_qk")

    def categories(self, source: str, places: DataFrame) -> DataFrame:
        """category, n: from the rarities of all that the source holds, for divisions from those imported."""
        if source == "places":
            return self.idf().select("category", F.col("n_places").alias("n"))
        return export.category_counts(places, F.col("primary_category" if source == "osm" else "subtype"))

    def run(self, source: str) -> str:
        """Builds and publishes the records of a source; returns the run's folder, the current one where nothing that
        it holds has changed since."""
        c = self.config
        places, key = self.places(source)
        assigned = self.assignments(places, key, source)
        related = self.related(places, key, source, assigned)
        record = {"places": lambda: export.place_record(dict(places.dtypes)), "osm": export.osm_record, "divisions": export.division_record}[source]()
        rkey = export.osm_rkey(F.col("rkey")) if source == "osm" else F.col("id").cast("string")
        inputs = [self.path(source), self.path(f"{source}_assignments"), *([self.path(f"{source}_containment")] if related is not None else [])]
        make = lambda: export.tile_records(places, key, assigned, related, record, rkey)
        by_prefix = lambda frame, to, name: sinks.write_by_prefix(frame, to, name, 6, "place_id")
        records = self.artifact(f"{source}_records", make, inputs, {}, "tile_qk", by_prefix)

        about, root = self.about(source), f"{c.output}/tiles/{source}"
        sources = [self.path(f"{source}_records"), self.path("idf" if source == "places" else source)]
        mark = {"state": sinks.state(self.spark, sources)[0], "collection": self.name(source), "repo": c.repo, "about": about}
        now, noted = sinks.current(self.spark, root), f"{root}/current.meta.json"
        if now and Files(self.spark).exists(f"{root}/{now}/manifest.json") and Files(self.spark).exists(noted) and json.loads(Files(self.spark).read_text(noted)) == mark:
            return f"{root}/{now}"
        out = f"{root}/{self.when}"
        self.publish(source, out, f"{root}/{now}" if now else None, records, related, places, about)
        sinks.make_current(self.spark, root, self.when)
        sinks.write_json(self.spark, noted, mark)
        sinks.retain(self.spark, root)
        self.made.append(f"tiles/{source}")
        return out

    def publish(self, source: str, out: str, last: str | None, records: DataFrame, related: DataFrame | None, places: DataFrame, about: dict[str, str]) -> None:
        """Writes a run: tiles (those of folders that didn't change are carried over from the last run), categories,
        collection.json, record_tiles and, at the end, manifest.json."""
        head = sinks.Head(self.name(source), about["source"], about["license"], self.when, self.config.repo)
        written, self.written = sinks.publish_changed(records, out, head, last)
        counts = self.categories(source, places)
        sinks.write_counts(counts, f"{out}/categories")
        told = {"collection": head.collection, "source": head.source, "license": head.license, "generatedAt": self.when}
        described = export.collection(records, related, source, told, about.get("attribution", ""))
        if described:
            sinks.write_described(self.spark, f"{out}/collection.json", described, counts if counts.columns and not counts.isEmpty() else None, f"{out}/categories")
        total = written.agg(F.count("*").alias("tiles"), F.sum("n").alias("n")).first()
        manifest = {"collection": head.collection, "generated_at": self.when, "tiles": total.tiles, "records": total.n or 0}
        if source == "divisions":
            bad = self.shapes().agg(F.sum("unusable").alias("areas"), F.count_if(F.col("geom").isNull()).alias("divisions")).first()
            manifest |= {"unusable_areas": bad.areas or 0, "divisions_without_area": bad.divisions}
        sinks.write_manifest(records, out, manifest)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    known = {"divisions": "divisions", "places": "places", "osm": "nodes"}
    parser.add_argument("what", choices=[*known, "all", "density", "idf", "covering"])
    parser.add_argument("--config", required=True, help="JSON or YAML with the fields of Config")
    args = parser.parse_args()
    build = Build(SparkSession.builder.getOrCreate(), load(args.config))
    with build.alone():
        if args.what in ("density", "idf"):
            build.scores()
        elif args.what == "covering":
            covering.stats(build.covering()).orderBy("zoom").show(100)
        else:
            for source in [s for s, name in known.items() if name in build.config.inputs] if args.what == "all" else [args.what]:
                print(build.run(source))


if __name__ == "__main__":
    main()
