"""Parameters as frozen values, checked where a run is put together."""

import dataclasses
import functools
import importlib
import os

from . import constants


def _connect(module: str, settings: dict, name: str):
    return importlib.import_module(module).connect(database=name, **settings)


@dataclasses.dataclass(frozen=True)
class Database:
    host: str | None = None
    port: int | None = None
    user: str | None = None
    user_r: str | None = None
    password: str = ""

    def reader(self, module: str):
        """A function that opens one of the server's databases by its name with a DB-API module, as the read-only user where there is one."""
        return self._as(module, self.user_r or self.user, "" if self.user_r else self.password)

    def writer(self, module: str):
        return self._as(module, self.user, self.password)

    def _as(self, module: str, user: str | None, password: str):
        settings = {"host": self.host, "port": self.port, "user": user, "password": password}
        return functools.partial(_connect, module, {k: v for k, v in settings.items() if v})


@dataclasses.dataclass(frozen=True)
class Parameters:
    """Of a run. Later settings win over earlier ones: see merged().

    projects: those allowed (none: any); short_name_projects: those whose summaries are named without species and
    accession; default_source: the annotation source of records that name none (none: such records are set aside).
    driver: the DB-API module that opens the database server's databases, and mark, its sign for a parameter.
    taxonomy_url: a service that is asked for taxa, whose answers are kept in taxonomy_dir. sql_dir: .sql files to run.
    """

    run_busco_core: bool = False
    run_busco_ncbi: bool = False
    run_omark: bool = False
    run_stats: bool = False
    run_beta_metakeys: bool = False
    apply_stats: bool = False
    apply_beta_metakeys: bool = False
    apply_busco_metakeys: bool = False
    csv_file: str | None = None
    out_dir: str | None = None
    project: str | None = None
    projects: tuple = ()
    short_name_projects: tuple = ()
    default_source: str | None = None
    team: str | None = None
    busco_mode: tuple | str = ("genome", "protein")
    busco_dataset: str | None = None
    datasets_file: str | None = None
    cache_dir: str | None = None
    taxonomy_url: str | None = None
    taxonomy_dir: str | None = None
    sql_dir: str | None = None
    driver: str | None = None
    mark: str = "?"
    database: Database = Database()

    def merged(self, *more: dict) -> "Parameters":
        out = self
        for settings in more:
            out = dataclasses.replace(out, **settings)
        return out

    def from_assemblies(self) -> bool:
        """Whether the manifest is one of assemblies, which have no databases."""
        return self.run_busco_ncbi and not self.run_busco_core

    def modes(self) -> list[str]:
        """Modes to run: a single one may be given as text; a run from assemblies has no proteins."""
        if self.from_assemblies():
            return ["genome"]
        return [self.busco_mode] if isinstance(self.busco_mode, str) else list(self.busco_mode)

    def problems(self) -> list[str]:
        """What is missing or wrong; empty if the run can start."""
        found = [f"{n} is required" for n in ("csv_file", "out_dir", "project") if not getattr(self, n)]
        if self.project and self.projects and self.project not in self.projects:
            found.append(f"project must be one of {', '.join(self.projects)}")
        if self.csv_file and "://" not in self.csv_file and not os.path.exists(self.csv_file):
            found.append(f"{self.csv_file} doesn't exist")
        found += [f"{m} is no mode" for m in self.modes() if m not in constants.LABELS]
        if self.sql_dir and not self.driver:
            found.append("driver is required to run SQL files")
        if self.taxonomy_url and not self.taxonomy_dir:
            found.append("taxonomy_dir is required to keep a service's answers")
        if self.run_beta_metakeys and not self.team:
            found.append("team is required for the beta metakeys")
        if self.from_assemblies() and (self.run_omark or self.run_stats or self.run_beta_metakeys):
            found.append("a manifest of assemblies names no databases for the other runs")
        return found

    def checked(self) -> "Parameters":
        if found := self.problems():
            raise ValueError("; ".join(found))
        return self
