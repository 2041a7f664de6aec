"""Small shards with made-up images for the job tests."""

import io
import json
import os
import tarfile

import numpy as np


def ppm(rgb: np.ndarray) -> bytes:
    return b"P6 %d %d 255\n" % (rgb.shape[1], rgb.shape[0]) + rgb.astype(np.uint8).tobytes()


def read_ppm(raw: bytes) -> np.ndarray:
    """Stand-in codec: binary PPM, since no image library is installed."""
    header, pixels = raw.split(b"\n", 1)
    magic, width, height, _ = header.split()
    if magic != b"P6":
        raise ValueError("not a PPM image")
    return np.frombuffer(pixels, np.uint8).reshape(int(height), int(width), 3)


def solid(value: int, share: float = 1.0, size: int = 10) -> np.ndarray:
    """An image whose first channel has ``value`` on ``share`` of its pixels."""
    rng = np.random.default_rng(value)
    image = rng.integers(0, 250, (size * size, 3))
    image[:, 0] = np.arange(size * size) % 251
    image[: round(share * size * size), 0] = 255
    return image.reshape(size, size, 3)


def write_tar(folder, name, entries) -> str:
    path = os.path.join(str(folder), name)
    with tarfile.open(path, "w") as archive:
        for entry, data in entries:
            info = tarfile.TarInfo(entry)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    return path


def sample(key, image=None, meta=None, ext="png", **parts):
    """Entries of one sample; ``parts`` are extra suffixes."""
    out = []
    if image is not None:
        out.append((f"{key}.{ext}", image if isinstance(image, bytes) else ppm(image)))
    if meta is not None:
        out.append((f"{key}.info.json", meta if isinstance(meta, bytes) else json.dumps(meta).encode()))
    return out + [(f"{key}.{suffix}", data) for suffix, data in parts.items()]
