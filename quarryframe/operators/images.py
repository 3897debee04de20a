"""Small image functions on NumPy arrays, for use inside batch functions: resize, pad, crop, depth filters, point sampling."""

from __future__ import annotations

import numpy as np

from .masks import dilate, disk, square


def resize_nearest(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pixel centres are kept in place: source index floor(i * old / new)."""
    return a[(np.arange(height) * a.shape[0]) // height][:, (np.arange(width) * a.shape[1]) // width]


def amodal_mask(rgb: np.ndarray, modal: np.ndarray, threshold: int = 600) -> np.ndarray:
    """Pixels whose channels sum to more than the threshold, resized to the modal mask and joined with it."""
    return resize_nearest(rgb.astype(np.int64).sum(axis=-1) > threshold, *modal.shape) | modal


def pad_square(image: np.ndarray, fill: int = 0) -> tuple[np.ndarray, tuple[int, int, int, int]]:
    """Centre an image in a square; also top, left, height and width for `cut_square`."""
    h, w = image.shape[:2]
    side = max(h, w)
    top, left = (side - h) // 2, (side - w) // 2
    out = np.full((side, side, *image.shape[2:]), fill, dtype=image.dtype)
    out[top : top + h, left : left + w] = image
    return out, (top, left, h, w)


def cut_square(image: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    top, left, h, w = box
    return image[top : top + h, left : left + w]


def masked_crop(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The mask's bounding box with everything else black; the whole image, black, if the mask is empty."""
    ys, xs = np.nonzero(mask)
    kept = np.where(mask[..., None], image, 0)
    return kept[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1] if len(ys) else kept


def overlay(image: np.ndarray, mask: np.ndarray, colour: tuple[int, int, int], alpha: float = 0.5) -> np.ndarray:
    return np.where(mask[..., None], (image * (1 - alpha) + np.array(colour) * alpha), image).astype(image.dtype)


def dilated_foreground(label: np.ndarray, times: int = 3) -> np.ndarray:
    mask = label > 0
    for _ in range(times):
        mask = dilate(mask, square(3))
    return mask


def eroded_depth(depth: np.ndarray, radius: int = 2, apart: float = 0.001, share: float = 0.8, far: float = 100.0) -> np.ndarray:
    """Zero where the depth is invalid or where more than `share` of the valid or invalid neighbours is apart from it."""
    valid = (depth >= 0.001) & (depth < far)
    padded, ok = np.pad(depth, radius), np.pad(valid, radius)
    inside = np.pad(np.ones_like(valid), radius)
    bad, total = np.zeros(depth.shape), np.zeros(depth.shape)
    for dy in range(2 * radius + 1):
        for dx in range(2 * radius + 1):
            window = np.s_[dy : dy + depth.shape[0], dx : dx + depth.shape[1]]
            total += inside[window]
            bad += inside[window] & (~ok[window] | (np.abs(padded[window] - depth) > apart))
    return np.where(valid & (bad / total <= share), depth, 0.0)


def bilateral_depth(depth: np.ndarray, radius: int = 2, near: float = 0.01, sigma_place: float = 2.0, far: float = 100.0) -> np.ndarray:
    """Mean of valid neighbours that are near in depth to the valid neighbourhood's mean, weighted by their distance."""
    valid = (depth >= 0.001) & (depth < far)
    padded, ok = np.pad(depth, radius), np.pad(valid, radius)
    windows = [(dy, dx, np.s_[dy : dy + depth.shape[0], dx : dx + depth.shape[1]]) for dy in range(2 * radius + 1) for dx in range(2 * radius + 1)]
    n = np.maximum(sum(ok[w] for _, _, w in windows), 1)
    mean = sum(np.where(ok[w], padded[w], 0.0) for _, _, w in windows) / n
    total, weights = np.zeros(depth.shape), np.zeros(depth.shape)
    for dy, dx, w in windows:
        use = ok[w] & (np.abs(padded[w] - mean) < near)
        k = use * np.exp(-((dy - radius) ** 2 + (dx - radius) ** 2) / (2 * sigma_place**2))
        total, weights = total + k * np.where(use, padded[w], 0.0), weights + k
    return np.where(weights > 0, total / np.maximum(weights, 1e-12), 0.0)


def sample_points(mask: np.ndarray, n: int, seed: int, key: int) -> np.ndarray:
    """Up to n (x, y) pixels of a mask without replacement, by a generator seeded with seed + key: the same on every run."""
    ys, xs = np.nonzero(mask)
    if not len(ys):
        return np.empty((0, 2), dtype=np.int64)
    chosen = np.random.default_rng(seed + key).choice(len(ys), size=min(n, len(ys)), replace=False)
    return np.stack((xs[chosen], ys[chosen]), axis=1)


def negative_points(mask: np.ndarray, others: np.ndarray, counts: tuple[int, int, int], ring: tuple[int, int], far: int, seed: int, key: int) -> np.ndarray:
    """Points around a mask that are not on it: in a ring of two radii, beyond a radius, and on other objects."""
    grow = lambda r: dilate(mask, disk(r))
    band, away = grow(ring[1]) & ~grow(ring[0]), ~grow(far)
    parts = [sample_points(region & ~mask, n, seed, key + 7919 * i) for i, (region, n) in enumerate(zip((band, away, others), counts))]
    return np.concatenate(parts)


def hard_pixels(probability: np.ndarray, label: np.ndarray, least_kept: int, threshold: float, ignore: int = 255) -> np.ndarray:
    """Valid pixels whose probability of their label is under max(threshold, the least_kept-th smallest)."""
    valid = label != ignore
    own = np.take_along_axis(probability, np.where(valid, label, 0)[None], axis=0)[0]
    ranked = np.sort(own[valid])
    if not len(ranked):
        return valid
    return valid & (own < max(threshold, ranked[min(least_kept, len(ranked) - 1)]))


def contiguous_frames(n: int, k: int, reverse_share: float, seed: int) -> list[int]:
    """k neighbouring frame numbers from a random start, backwards with a given probability; an error if there are too few."""
    if n < k:
        raise ValueError("not enough frames")
    draw = np.random.default_rng(seed)
    start = int(draw.integers(0, n - k + 1))
    frames = list(range(start, start + k))
    return frames[::-1] if draw.random() < reverse_share else frames
