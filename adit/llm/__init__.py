"""Operations for preparing training text: tokens, duplicates, quality, safety, mixing, chat.

Nothing outside this folder imports it. Every module states what it does with nulls, empty and
very long texts, repeated rows and empty tables; operators read only the columns they are told
to read and return only columns of their own, so extra columns of an input cannot clash.
"""
