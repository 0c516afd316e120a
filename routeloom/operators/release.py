"""Releases: digests, comparison, validation by violation queries, create-only publication, bundles."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import GateError


def row_text(df: DataFrame) -> Column:
    """A row as text with columns in order of name; null differs from empty."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})


def content_digest(df: DataFrame, name: str) -> DataFrame:
    """(table, n_rows, digest): independent of row order and partitioning, and no row is moved.

    The digest is the sum of the rows' 128-bit hashes in four parts, so repeated
    rows count.
    """
    h = F.md5(row_text(df))
    sums = [F.sum(F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")) for i in range(4)]
    text = F.concat_ws("-", *[F.coalesce(s, F.lit(0)).cast("string") for s in sums])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(text, 256).alias("digest")).select(F.lit(name).alias("table"), "n_rows", "digest")


def science_keys(hashes: DataFrame) -> DataFrame:
    """Hashes of science tables: paths of the registry are a release's own."""
    return hashes.filter(~F.col("table").startswith("registry/") & ~F.col("table").endswith("scenario_registry.csv"))


def differences(one: DataFrame, two: DataFrame) -> DataFrame:
    """Tables that two runs don't share or that differ: none if the runs agree."""
    a = one.select("table", F.col("digest").alias("first"))
    b = two.select("table", F.col("digest").alias("second"))
    return a.join(b, "table", "full_outer").filter(~F.col("first").eqNullSafe(F.col("second")))


def permitted(inputs: DataFrame) -> DataFrame:
    return inputs.filter(F.coalesce("redistribution_permitted", F.lit(False)))


def omitted_inputs(inputs: DataFrame, include_raw: bool = True) -> DataFrame:
    """Inputs that a bundle must leave out."""
    return inputs.join(permitted(inputs).select("path"), "path", "left_anti") if include_raw else inputs


def missing_members(required: DataFrame, present: DataFrame) -> DataFrame:
    return required.select("name").exceptAll(present.select("name").distinct())


def validate(checks: dict[str, DataFrame]) -> dict:
    """Each check is a query of violating rows; passed if all are empty."""
    found = {k: v.limit(1).count() == 0 for k, v in checks.items()}
    return {"passed": all(found.values()), "checks": found}


# -- files ---------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p(path))


def publish(spark: SparkSession, tables: dict[str, DataFrame | Callable[[], DataFrame]], root: str, manifest: dict | None = None, fmt: str = "parquet", keys: dict[str, list[str]] | None = None, check: Callable[[str], None] | None = None) -> dict:
    """Writes tables under a staging folder of its own beside ``root`` and renames it when all are there.

    An existing ``root`` is an error, also where another publisher makes it meanwhile;
    a table or gate that fails leaves nothing, and nobody else's files are touched.
    Digests are of the tables as they were written, read back; ``check`` gets the staging
    folder when all is written and may raise.  CSV tables are sorted by their keys into one file each; Parquet ones stay as
    they are distributed.
    """
    if exists(spark, root):
        raise GateError(f"{root} must be a new, unprotected path")
    stage = f"{root.rstrip('/')}.staging-{uuid.uuid4().hex}"
    fs, path = _fs(spark, root)
    try:
        hashes = {}
        for name, made in tables.items():
            df = made() if callable(made) else made
            out = df
            if fmt == "csv":
                out = df.orderBy(*(keys or {}).get(name, sorted(df.columns))).coalesce(1)
            writer = out.write.mode("errorifexists")
            (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(f"{stage}/{name}")
            reader = spark.read.schema(df.schema)
            written = reader.option("header", True).csv(f"{stage}/{name}") if fmt == "csv" else reader.parquet(f"{stage}/{name}")
            hashes[name] = content_digest(written, name).first().digest
        if check is not None:
            check(stage)
        note = {"status": "published", **(manifest or {}), "core_hashes": hashes}
        write_text(spark, f"{stage}/manifest.json", json.dumps(note, indent=1, sort_keys=True))
        _move(spark, stage, root)
        return note
    except BaseException:
        fs.delete(path(stage), True)
        raise


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder; an existing target is an error and never gets it inside."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, path = _fs(spark, target)
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(path(source), path(target), none)
    except Exception as e:
        raise GateError(f"{target} could not be published") from e


def write_bytes(spark: SparkSession, file: str, data: bytes) -> None:
    fs, path = _fs(spark, file)
    out = fs.create(path(file), False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_text(spark: SparkSession, file: str, text: str) -> None:
    write_bytes(spark, file, text.encode())


def read_text(spark: SparkSession, file: str) -> str:
    return spark.read.format("binaryFile").load(file).select("content").first().content.decode()


def file_digest(spark: SparkSession, file: str) -> tuple[int, str]:
    """(bytes, sha256) of a file of any size, by Hadoop's streams."""
    jvm = spark._jvm
    fs, path = _fs(spark, file)
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    source = jvm.java.security.DigestInputStream(fs.open(path(file)), digest)
    try:
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, jvm.java.io.OutputStream.nullOutputStream(), 1 << 16, False)
    finally:
        source.close()
    return fs.getFileStatus(path(file)).getLen(), bytes(digest.digest()).hex()


INPUTS = "role string, path string, n_bytes long, sha256 string, provider string, licence string, license_verified boolean, redistribution_permitted boolean"


def input_registry(spark: SparkSession, inputs: list[dict]) -> DataFrame:
    """A row for each input of a profile: what it is, whose, under which licence, and its digest as it was used.

    A missing file, or one that isn't what the profile says by ``sha256``, is an error.
    """
    rows = []
    for i in inputs:
        if not exists(spark, i["path"]):
            raise GateError(f"input {i['role']}: {i['path']} is missing")
        size, digest = file_digest(spark, i["path"])
        if i.get("sha256") not in (None, digest):
            raise GateError(f"input {i['role']}: {i['path']} is not the file that the profile names")
        rows.append((i["role"], i["path"], size, digest, i.get("provider"), i.get("licence"), bool(i.get("license_verified")), bool(i.get("redistribution_permitted"))))
    return spark.createDataFrame(rows, INPUTS)


def reuse_or_build(spark: SparkSession, root: str | None, names: list[str], build: Callable[[], dict[str, DataFrame]]) -> tuple[dict[str, DataFrame], bool]:
    """Tables of a published mother release, or built ones: (tables, reused)."""
    if root is None:
        return build(), False
    note = json.loads(read_text(spark, f"{root}/manifest.json"))
    if note.get("status") != "published" or any(n not in note["core_hashes"] for n in names):
        raise GateError(f"{root} is no published release with {names}")
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}, True


def release_files(spark: SparkSession, root: str) -> dict[str, str]:
    """Members of a published release by name; one whose manifest or a table of it is missing is an error."""
    fs, path = _fs(spark, root)
    if not exists(spark, f"{root}/manifest.json"):
        raise GateError(f"{root} has no manifest")
    note = json.loads(read_text(spark, f"{root}/manifest.json"))
    base, found, files = fs.makeQualified(path(root)).toString(), {}, fs.listFiles(path(root), True)
    while files.hasNext():
        file = files.next().getPath()
        if not file.getName().startswith((".", "_")):
            found[file.toString()[len(base) + 1 :]] = file.toString()
    absent = sorted(t for t in note.get("core_hashes", {}) if not any(name.startswith(f"{t}/") for name in found))
    if note.get("status") != "published" or absent:
        raise GateError(f"{root} is no whole release: {absent or note.get('status')}")
    return found


def bundle(spark: SparkSession, root: str, inputs: list[dict], out: str, include_raw: bool) -> dict:
    """A ZIP of a published release and of the inputs that may be passed on, with a manifest of the rest.

    ``inputs``: role, path and redistribution_permitted of each.  Files are copied one by
    one, piece by piece and by Hadoop's streams, to ``out``, which must be new; no file
    is ever held whole.
    """
    members = {f"release/{k}": v for k, v in release_files(spark, root).items()}
    allowed = [i for i in inputs if include_raw and i.get("redistribution_permitted")]
    omitted = [i for i in inputs if i not in allowed]
    members |= {f"inputs/{i['role']}/{i['path'].rpartition('/')[2]}": i["path"] for i in allowed}
    if exists(spark, out):
        raise GateError(f"{out} must be a new, unprotected path")
    fs, path = _fs(spark, out)
    part = f"{out}.part-{uuid.uuid4().hex}"
    jvm = spark._jvm
    sink = jvm.java.util.zip.ZipOutputStream(fs.create(path(part), False))

    def put(name: str, source) -> None:
        entry = jvm.java.util.zip.ZipEntry(name)
        entry.setTimeLocal(jvm.java.time.LocalDateTime.of(1980, 1, 1, 0, 0))
        sink.putNextEntry(entry)
        try:
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, sink, 1 << 16, False)
        finally:
            source.close()
        sink.closeEntry()

    try:
        for name in sorted(members):
            at, where = _fs(spark, members[name])
            put(name, at.open(where(members[name])))
        note = json.dumps({"omitted_inputs": omitted, "members": sorted(members)}, indent=1, sort_keys=True)
        put("DATASET_BUNDLE_MANIFEST.json", jvm.java.io.ByteArrayInputStream(bytearray(note.encode())))
        sink.close()
        _move(spark, part, out)
    except BaseException:
        sink.close()
        fs.delete(path(part), False)
        raise
    return {"omitted_input_count": len(omitted), "members": len(members) + 1}


def download_plan(catalogue: DataFrame) -> DataFrame:
    """What to do about each catalogue entry; nothing is fetched."""
    from ..functions import has_credentials

    host = F.expr("try_parse_url(download_url, 'HOST')")
    status = (
        F.when(F.col("download_url").isNull(), "manual_download_required")
        .when(has_credentials(F.col("download_url")), "credential-bearing")
        .when(F.col("allowed_hosts").isNotNull() & ~F.coalesce(F.array_contains("allowed_hosts", host), F.lit(False)), "host_not_allowed")
        .otherwise("dry_run")
    )
    return catalogue.withColumn("status", status)


def require_plan(plan: DataFrame) -> DataFrame:
    bad = plan.filter(F.col("status").isin("credential-bearing", "host_not_allowed")).select("role", "status").first()
    if bad is not None:
        raise GateError(f"{bad.role}: {bad.status} download URL")
    return plan
