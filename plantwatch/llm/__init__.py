"""Operations of a training-data pipeline over documents, vectors and web records."""
