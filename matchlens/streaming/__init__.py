"""Keyed message streams."""

from matchlens.streaming.messages import (
    KeyedState,
    decode_messages,
    kafka_options,
    land_messages,
    print_messages,
    read_messages,
    send_to_keyed_files,
    write_keyed_files,
    write_messages,
)

__all__ = [
    "KeyedState",
    "decode_messages",
    "kafka_options",
    "land_messages",
    "print_messages",
    "read_messages",
    "send_to_keyed_files",
    "write_keyed_files",
    "write_messages",
]
