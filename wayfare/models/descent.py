"""Minimising a smooth function of a parameter vector (limited-memory BFGS)."""

from collections import deque
from collections.abc import Callable

import numpy as np

Evaluate = Callable[[np.ndarray], tuple[float, np.ndarray]]

# Shares of the first slope that a step must gain in value, and lose in steepness.
GAIN, STEEPNESS, TRIALS = 1e-4, 0.9, 30


def _direction(gradient: np.ndarray, changes: deque) -> np.ndarray:
    """The negative gradient turned by the curvature that earlier steps saw."""
    turned, shares = -gradient, []
    for step, change in reversed(changes):
        share = (step @ turned) / (step @ change)
        turned = turned - share * change
        shares.append(share)
    if changes:
        step, change = changes[-1]
        turned = turned * ((step @ change) / (change @ change))
    for (step, change), share in zip(changes, reversed(shares)):
        turned = turned + step * (share - (change @ turned) / (step @ change))
    return turned


def _search(evaluate: Evaluate, start, value, slope, direction, length):
    """A step along the direction with enough gain and a flatter slope, by halving and doubling."""
    low, high = 0.0, np.inf
    for _ in range(TRIALS):
        place = start + length * direction
        found, gradient = evaluate(place)
        if not found <= value + GAIN * length * slope:
            high = length
        elif gradient @ direction < STEEPNESS * slope:
            low = length
        else:
            break
        length = (low + high) / 2 if np.isfinite(high) else 2 * low
    return place, found, gradient


def minimise(
    evaluate: Evaluate, start: np.ndarray, iterations: int, tolerance: float = 1e-6, memory: int = 10
) -> tuple[np.ndarray, list[float]]:
    """The last place and the values on the way, the first included.

    ``evaluate`` gives value and gradient. It ends when the value, relative to 1 or itself, gains less
    than ``tolerance``, or when no step gains anything.
    """
    place = np.asarray(start, float)
    value, gradient = evaluate(place)
    values, changes = [value], deque(maxlen=memory)
    for _ in range(iterations):
        direction = _direction(gradient, changes)
        slope = float(gradient @ direction)
        if not slope < 0:
            break
        length = 1.0 if changes else min(1.0, 1.0 / float(np.linalg.norm(gradient)))
        next_place, next_value, next_gradient = _search(
            evaluate, place, value, slope, direction, length
        )
        if not next_value < value:
            break
        step, change = next_place - place, next_gradient - gradient
        if step @ change > 0:
            changes.append((step, change))
        gained = value - next_value
        place, value, gradient = next_place, next_value, next_gradient
        values.append(value)
        if gained <= tolerance * max(abs(value), 1.0):
            break
    return place, values
