def words_of(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(9)}" for _ in range(n))
