"""Where the primary-key map at a location is, and how a new one takes its place.

    <parent>/<name>                              the map, for any program to read
    <parent>/_<name>.new-<load>/                 a map that was written and is not in place yet
    <parent>/_<name>.versions/0000000007.<load>  an empty file that names the current map

A load writes its map beside the old one, registers its vertices, and then creates the
version file.  That one file is the commit: before it the old map is current, after it the
new one is, and nothing of the old map is touched earlier.  What comes after it (the old map
goes, the new one is renamed) can be repeated.  A swap whose job died is finished by the next
job that uses the location, or dropped if the load was never registered.  A location without
versions holds a map as any program may write it.  One writer at a time is assumed, as for
the rest of the graph.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from weftgraph.sources.shared import create_empty, exists, list_names, move, remove


def _beside(location: str) -> tuple[str, str]:
    """The folder that the map is in, and what names of files that belong to it start with."""
    parent, _, name = location.rstrip("/").rpartition("/")
    return parent or ("/" if location.startswith("/") else "."), f"_{name}."


def _versions_folder(location: str) -> str:
    parent, name = _beside(location)
    return f"{parent}/{name}versions"


def new_folder(location: str, load_id: str) -> str:
    """Where the map of a load waits."""
    parent, name = _beside(location)
    return f"{parent}/{name}new-{load_id}"


def waiting_loads(spark: SparkSession, location: str) -> set[str]:
    """Loads whose maps were written for the location and are not in place."""
    parent, name = _beside(location)
    start = f"{name}new-"
    return {n.removeprefix(start) for n in list_names(spark, parent) if n.startswith(start)}


def _versions(spark: SparkSession, location: str) -> list[str]:
    """Names of the version files, oldest first."""
    return sorted(list_names(spark, _versions_folder(location)))


def _load_of(version: str) -> str:
    return version.split(".", 1)[1]


def current_folder(spark: SparkSession, location: str) -> str:
    """The folder that holds the current map."""
    versions = _versions(spark, location)
    if versions and exists(spark, waiting := new_folder(location, _load_of(versions[-1]))):
        return waiting
    return location


def publish(spark: SparkSession, location: str, load_id: str) -> None:
    """Makes the load's map the current one."""
    versions = _versions(spark, location)
    number = int(versions[-1].split(".", 1)[0]) + 1 if versions else 1
    create_empty(spark, f"{_versions_folder(location)}/{number:010d}.{load_id}")
    tidy(spark, location)


def tidy(spark: SparkSession, location: str) -> None:
    """Puts the current map in the place of the one it replaced."""
    versions = _versions(spark, location)
    if versions and exists(spark, waiting := new_folder(location, _load_of(versions[-1]))):
        remove(spark, location)
        move(spark, waiting, location)
    for name in versions[:-1]:
        remove(spark, f"{_versions_folder(location)}/{name}")


def settle(spark: SparkSession, location: str, loads: list[str], drop_others: bool = False) -> None:
    """Finishes the swaps of jobs that died.

    ``loads`` are the ids of the registered loads, oldest first.  The newest of them whose
    map waits becomes current; older ones were replaced by it.  Maps of loads that were never
    registered go with ``drop_others``, which the next writer asks for.
    """
    waiting = waiting_loads(spark, location)
    if not waiting:
        return
    versions = _versions(spark, location)
    current = _load_of(versions[-1]) if versions else None
    registered = [i for i in loads if i in waiting]
    if registered and registered[-1] != current:
        publish(spark, location, registered[-1])
    elif current in waiting:
        tidy(spark, location)
    for load_id in waiting - set(registered[-1:]) - {current}:
        if load_id in registered or drop_others:
            remove(spark, new_folder(location, load_id))
