"""Settings from the environment, checked once and immutable."""

from __future__ import annotations

import logging
import logging.handlers
import os
from dataclasses import asdict, dataclass, replace
from functools import cache


@dataclass(frozen=True)
class Config:
    input_folder: str = ""
    output_folder: str = ""
    ledger_path: str = "data/processed_files"
    credentials_path: str = "credentials/service_account.json"
    token_path: str = "credentials/token.json"
    scopes: tuple[str, ...] = ()
    polling_interval_seconds: int = 60
    max_retries: int = 3
    retry_delay_seconds: int = 5
    ocr_command: str = ""
    ocr_language: str = "hin+eng"
    ocr_config: str = "--oem 3 --psm 6"
    log_level: str = "INFO"
    log_file: str = "logs/pipeline.log"
    max_log_size_mb: int = 10
    log_backup_count: int = 5
    csv_encoding: str = "utf-8-sig"
    csv_delimiter: str = ","
    max_files: int | None = None
    default_csv_columns: tuple[str, ...] = ("original_filename", "hindi_name", "english_name", "english_name_lowercase", "extraction_timestamp", "page_number", "confidence_score")

    def __post_init__(self):
        errors = [
            text
            for wrong, text in (
                (not self.input_folder, "INPUT_FOLDER is required"),
                (not self.output_folder, "OUTPUT_FOLDER is required"),
                (self.polling_interval_seconds < 1, "POLLING_INTERVAL_SECONDS must be at least 1"),
                (self.max_retries < 0, "MAX_RETRIES must be non-negative"),
                (self.retry_delay_seconds < 0, "RETRY_DELAY_SECONDS must be non-negative"),
            )
            if wrong
        ]
        if errors:
            raise ValueError("; ".join(errors))

    def get(self, key: str, default=None):
        return getattr(self, key, default)

    def get_all(self) -> dict:
        return asdict(self)

    def update(self, **changes) -> Config:
        """A checked copy with changes; this one stays as it is."""
        return replace(self, **changes)


def from_environment(env: dict[str, str] | None = None) -> Config:
    env = dict(os.environ) if env is None else env
    kinds = {f: type(getattr(Config, f)) for f in Config.__dataclass_fields__ if hasattr(Config, f)}
    values = {}
    for name, kind in kinds.items():
        if (raw := env.get(name.upper())) is not None:
            values[name] = tuple(raw.split(",")) if kind is tuple else int(raw) if kind is int or name == "max_files" else raw
    return Config(**values)


def read_env_file(path: str) -> dict[str, str]:
    """KEY=value lines; comments and blank lines are skipped, quotes around a value go."""
    out = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            key, sep, value = line.strip().partition("=")
            if sep and not key.startswith("#"):
                out[key.strip()] = value.strip().strip("'\"")
    return out


@cache
def get_config(env_file: str | None = None) -> Config:
    return from_environment({**os.environ, **(read_env_file(env_file) if env_file else {})})


def reload_config(env_file: str | None = None) -> Config:
    get_config.cache_clear()
    return get_config(env_file)


def setup_logging(config: Config) -> logging.Logger:
    """A rotating file and the console."""
    log = logging.getLogger("lipiflow")
    log.setLevel(config.log_level)
    os.makedirs(os.path.dirname(config.log_file) or ".", exist_ok=True)
    form = logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s")
    for handler in (logging.handlers.RotatingFileHandler(config.log_file, maxBytes=config.max_log_size_mb << 20, backupCount=config.log_backup_count, encoding="utf-8"), logging.StreamHandler()):
        handler.setFormatter(form)
        log.addHandler(handler)
    return log
