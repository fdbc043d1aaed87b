"""Message moderation and windowed statistics; the same functions serve batch and stream."""
