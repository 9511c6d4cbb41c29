"""kilovela.plans"""
