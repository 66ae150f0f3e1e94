"""Training-data operators over documents, pages, embeddings and conversations."""
