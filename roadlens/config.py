"""Service settings from the environment, and dataset descriptors."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """The service's defaults."""

    confidence: float = 0.35
    iou: float = 0.45
    image_size: int = 640
    max_image_mb: float = 10.0
    timeout_ms: int = 30000
    origins: list[str] = field(default_factory=lambda: ["http://localhost:5000"])
    backend: str = "torch"
    model_repo: str = ""
    model_file: str = "best.pt"
    model_path: str = "models/best.pt"
    log_level: str = "INFO"
    content_types: tuple[str, ...] = ("image/jpeg", "image/png")

    def weights(self) -> tuple[str, str, str]:
        """(where to look, file or path, model version): the repository if one is named, else the path; the version is the file's stem."""
        where, name = ("repository", f"{self.model_repo}/{self.model_file}") if self.model_repo else ("path", self.model_path)
        return where, name, os.path.splitext(os.path.basename(name))[0]

    @classmethod
    def from_environment(cls, env: dict | None = None) -> Settings:
        """Values of the ML_ variables of the service where they are set; the weights' file goes by the backend."""
        e = os.environ if env is None else env
        base = cls()
        return cls(
            confidence=float(e.get("ML_CONFIDENCE_THRESHOLD", base.confidence)),
            max_image_mb=float(e.get("ML_MAX_IMAGE_SIZE_MB", base.max_image_mb)),
            timeout_ms=int(e.get("ML_TIMEOUT_MS", base.timeout_ms)),
            origins=e["ML_ALLOWED_ORIGINS"].split(",") if "ML_ALLOWED_ORIGINS" in e else base.origins,
            backend=(backend := e.get("ML_BACKEND", base.backend)),
            model_repo=e.get("ML_HF_MODEL_REPO", base.model_repo),
            model_file=e.get("ML_HF_MODEL_FILE", "best.pt" if backend == "torch" else "best.onnx"),
            model_path=e.get("ML_MODEL_PATH", base.model_path),
            log_level=e.get("ML_LOG_LEVEL", base.log_level),
        )


def read_descriptor(path: str) -> dict:
    """path, train, val, test and names of a dataset's YAML descriptor."""
    import yaml

    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f)
    missing = {"path", "train", "val", "names"} - set(found)
    if missing:
        raise ValueError(f"descriptor lacks {sorted(missing)}")
    return found
