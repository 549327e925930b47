"""Settings from the environment, checked."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace

from notewright.errors import ConfigurationError

#: The environment's name for each setting, where it is not the setting in capitals.
_NAMES = {"catalog_path": "ICD10_DATASET_PATH", "use_api_for_codes": "USE_API_FOR_CODES"}


@dataclass(frozen=True)
class Settings:
    """Settings of note generation."""

    llm_provider: str = "gemini"
    api_keys: Mapping[str, str] = field(default_factory=dict)
    catalog_path: str | None = None
    use_api_for_codes: bool = False
    min_codes_per_note: int = 2
    max_codes_per_note: int = 5
    max_retries: int = 3
    rate_limit_delay: float = 0.5
    enable_validation: bool = True
    confidence_threshold: float = 70.0
    output_directory: str = "output"

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Defaults overridden by the environment.

        A provider whose key is missing gives way to OpenAI when only that key is there.
        """
        env = os.environ if env is None else env
        keys = {"gemini": env.get("GEMINI_API_KEY") or env.get("GOOGLE_API_KEY"), "openai": env.get("OPENAI_API_KEY")}
        out = cls(api_keys={k: v for k, v in keys.items() if v})
        for f in fields(cls):
            raw = env.get(_NAMES.get(f.name, f.name.upper()))
            if f.name == "api_keys" or raw is None:
                continue
            kind = type(f.default)
            try:
                value = raw.strip().lower() == "true" if kind is bool else kind(raw) if kind in (int, float) else raw
            except ValueError as e:
                raise ConfigurationError("not a number", setting=f.name, value=raw) from e
            out = replace(out, **{f.name: value})
        if out.llm_provider == "gemini" and set(out.api_keys) == {"openai"}:
            out = replace(out, llm_provider="openai")
        return out

    def check(self) -> Settings:
        """The settings themselves; an error for the first that can't be."""
        if self.llm_provider not in self.api_keys:
            raise ConfigurationError("an API key is required", provider=self.llm_provider)
        if self.catalog_path and not self.use_api_for_codes and "://" not in self.catalog_path and not os.path.exists(self.catalog_path):
            raise ConfigurationError("catalogue not found", path=self.catalog_path)
        if not 0 < self.min_codes_per_note <= self.max_codes_per_note:
            raise ConfigurationError("invalid range of codes", min=self.min_codes_per_note, max=self.max_codes_per_note)
        if not 0 <= self.confidence_threshold <= 100:
            raise ConfigurationError("confidence threshold must be 0 to 100", threshold=self.confidence_threshold)
        return self


@dataclass(frozen=True)
class PrepareSettings:
    """Settings of data preparation; the environment's names start with FT_."""

    raw_data_path: str = "data/raw.json"
    processed_data_dir: str = "data/processed"
    max_seq_length: int = 1024
    validation_split: float = 0.2
    random_seed: int = 42

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None) -> PrepareSettings:
        env = os.environ if env is None else env
        found = {f.name: type(f.default)(env["FT_" + f.name.upper()]) for f in fields(cls) if "FT_" + f.name.upper() in env}
        return cls(**found)
