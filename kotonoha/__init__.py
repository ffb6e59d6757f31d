"""Corpus analytics on Spark: documents, tokens, counts, n-grams, vectors."""

from kotonoha.operators.candidates import similar_pairs
from kotonoha.operators.derived import derive_lists, derive_tokens, fit_schema, token_problems
from kotonoha.operators.filters import (
    drop_frequent_words,
    filter_tokens,
    frequency_stopwords,
    stopword_table,
)
from kotonoha.operators.frequency import (
    cloud_weights,
    column_sums,
    corpus_size,
    document_word_counts,
    id_range,
    pos_distribution,
    term_frequency,
    tf_idf,
    vocabulary,
    vocabulary_index,
)
from kotonoha.operators.graph import (
    cooccurrence_graph,
    edge_widths,
    edges,
    merge_edges,
    node_degrees,
)
from kotonoha.operators.lists import (
    LIST_VARIANTS,
    change_words,
    filter_lists,
    keep_tokens,
    select_form_in_lists,
    text_of_lists,
    words_of_lists,
)
from kotonoha.operators.ngram import (
    count_ngrams,
    count_ngrams_of_lists,
    ngram_rows,
    ngram_rows_of_lists,
)
from kotonoha.operators.packing import pack_documents
from kotonoha.operators.reader import (
    CorpusReader,
    corpus_reader,
    corpus_text,
    read_range,
    tokens_to_text,
    word_lists,
    write_corpus_text,
)
from kotonoha.operators.tokenize import (
    ArrowTokenizer,
    FrameTokenizer,
    TextTokenizer,
    select_word_form,
    split_text,
    text_tokenizer,
    tokenize,
    tokenize_lists,
    tokenize_words,
)
from kotonoha.operators.variants import (
    VARIANTS,
    filtered_variant,
    hybrid_variant,
    mask_number_words,
    surface_variant,
)
from kotonoha.plans.store import CorpusStore
from kotonoha.session import build_session

__all__ = [name for name in dir() if not name.startswith("_")]
