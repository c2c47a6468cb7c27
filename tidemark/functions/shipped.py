"""User functions stored as pickled bytes, so that jobs can load them by path, and what they need
on the executors: this library, other pure Python packages, environment variables.

Loading runs whatever the file holds: only load files you trust.
"""

from __future__ import annotations

import functools
import io
import os
import zipfile
from collections.abc import Callable, Iterable, Mapping
from importlib.util import find_spec

from pyspark import cloudpickle
from pyspark.sql import SparkSession

from tidemark import files
from tidemark.plans.lineage import scratch_path


def save_function(
    spark: SparkSession, function: Callable, path: str, *, environment: Mapping[str, str] | None = None
) -> None:
    """Store a function, including what it refers to, at a new path. `environment` is set wherever
    the function runs, while it runs."""
    stored = with_environment(function, environment) if environment else function
    if not files.create_bytes(spark, path, cloudpickle.dumps(stored)):
        raise FileExistsError(path)


def load_function(spark: SparkSession, path: str) -> Callable:
    return cloudpickle.loads(files.read_bytes(spark, path))


def with_environment(function: Callable, environment: Mapping[str, str]) -> Callable:
    """The function, run with these environment variables; those that were there come back."""
    wanted = dict(environment)

    @functools.wraps(function)
    def run(*args, **kwargs):
        before = {name: os.environ.get(name) for name in wanted}
        os.environ.update(wanted)
        try:
            return function(*args, **kwargs)
        finally:
            for name, value in before.items():
                if value is None:
                    os.environ.pop(name, None)
                else:
                    os.environ[name] = value

    return run


def ship_packages(spark: SparkSession, packages: Iterable[str] = ("tidemark",)) -> list[str]:
    """Send pure Python packages that this driver can import to all executors, as one archive each
    in the shared folder; tasks that start afterwards can import them. Returns the archives.

    Without it executors need the packages installed. Packages with compiled parts must be: they
    raise here.
    """
    paths = []
    for package in packages:
        path = f"{scratch_path(spark, 'package')}/{package}.zip"
        files.create_bytes(spark, path, _archive(package))
        spark.sparkContext.addPyFile(path)
        paths.append(path)
    return paths


def _archive(package: str) -> bytes:
    spec = find_spec(package)
    if spec is None or "." in package:
        raise ModuleNotFoundError(f"no top-level package {package!r}")
    roots = list(spec.submodule_search_locations or [])
    found = io.BytesIO()
    with zipfile.ZipFile(found, "w", zipfile.ZIP_DEFLATED) as archive:
        if not roots:
            archive.write(spec.origin, os.path.basename(spec.origin))
        for root in roots:
            for folder, _, names in os.walk(root):
                for name in sorted(names):
                    if name.endswith((".so", ".pyd")):
                        raise ValueError(f"{package!r} has compiled parts, install it on the executors: {name}")
                    if "__pycache__" not in folder:
                        whole = os.path.join(folder, name)
                        archive.write(whole, os.path.join(package, os.path.relpath(whole, root)))
    return found.getvalue()
